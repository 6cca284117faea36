"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from . import chat, decontaminate, fingerprint, fixity, hardneg, language, linededup, lmscore, neardup, packing, sharding, spelling, tokenfiles

QUERIES = {
    "op1_probminhash_groups": neardup.query,
    "op2_paragraph_sketches": fingerprint.query,
    "op3_chat_prefix_targets": chat.query,
    "op4_mixture_em": language.query,
    "op5_retrieval_packing": packing.query,
    "op6_deletion_neighbours": linededup.query,
    "op7_positional_index": decontaminate.query,
    "op8_backoff_automaton": lmscore.query,
    "op9_warc_fixity": fixity.query,
    "op10_feistel_shards": sharding.query,
    "op11_shared_list_negatives": hardneg.query,
    "op12_seekable_token_files": tokenfiles.query,
    "op13_bit_sliced_variants": spelling.query,
}

ORACLES = {
    "op3_chat_prefix_targets": chat.ORACLE,
    "op6_deletion_neighbours": linededup.ORACLE,
    "op7_positional_index": decontaminate.ORACLE,
    "op9_warc_fixity": fixity.ORACLE,
    "op10_feistel_shards": sharding.ORACLE,
    "op11_shared_list_negatives": hardneg.ORACLE,
    "op13_bit_sliced_variants": spelling.ORACLE,
}
