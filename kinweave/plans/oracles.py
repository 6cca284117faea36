"""DuckDB SQL for the registered queries of the family analysis."""

from __future__ import annotations

from ..operators import seeding
from ..operators.scoring import GROUPS, UNKNOWN
from .queries import IDENTITY, LINEAR_IDENTITY, TRIM_END, TRIM_START, WHOLE_SCORES


def trim_key(c: str, start: int, end: int) -> str:
    rest = f"substr({c}, {start + 1})"
    return f"CASE WHEN length({rest}) > {end} THEN left({rest}, (length({rest}) - {end})::BIGINT) ELSE {rest} END" if end else rest


def trim_report(c: str, start: int, end: int) -> str:
    rest = f"substr({c}, {start + 1})"
    return f"left({rest}, greatest(length({rest}) - {end}, 0)::BIGINT)" if end else rest


def _clones(chains: int) -> str:
    parts = "word AS sequence_0"
    if chains == 2:
        half = "(length(word) + 1) // 2"
        parts = f"left(word, ({half})::BIGINT) AS sequence_0, substr(word, ({half} + 1)::BIGINT) AS sequence_1"
    return f"""words AS (
  SELECT coalesce(lang, 'none') AS sampleId, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS word FROM documents
), counted AS (
  SELECT sampleId, word, count(*)::BIGINT AS abundance FROM words WHERE word <> '' GROUP BY sampleId, word
), clones AS (
  SELECT sampleId, 'k-' || word AS clonotypeKey, abundance, {parts}, CASE WHEN word < 'm' THEN 'C-' ELSE 'P-' END || word AS clonotypeKeyLabel FROM counted
)"""


def _seqs(chains: int) -> str:
    cols = ", ".join(f"min(sequence_{k}) AS sequence_{k}" for k in range(chains))
    return f"{_clones(chains)}, seqs AS (SELECT clonotypeKey, {cols}, min(clonotypeKeyLabel) AS label FROM clones GROUP BY clonotypeKey)"


def _keyed(chains: int) -> str:
    joined = " || '====' || ".join(f"sequence_{k}" for k in range(chains))
    return f"""{_seqs(chains)}, keyed AS (SELECT clonotypeKey, {trim_key(f'({joined})', TRIM_START, TRIM_END)} AS sequence FROM seqs)
, mapping AS (SELECT min(clonotypeKey) OVER (PARTITION BY sequence) AS representativeKey, clonotypeKey FROM keyed)
, reps AS (SELECT min(clonotypeKey) AS clonotypeKey, sequence FROM keyed GROUP BY sequence HAVING length(replace(sequence, '=', '')) > 0)"""


_RULE = "length(sequence), left(sequence, 4)"


def _members(chains: int = 1, rule: str = _RULE) -> str:
    return f"""{_keyed(chains)}
, clusters AS (SELECT min(clonotypeKey) OVER (PARTITION BY {rule}) AS clusterId, clonotypeKey FROM reps)
, members AS (SELECT clusterId, m.clonotypeKey FROM clusters c JOIN mapping m ON m.representativeKey = c.clonotypeKey)
, sizes AS (SELECT clusterId, count(*)::BIGINT AS size FROM members GROUP BY clusterId)
, labels AS (SELECT clonotypeKey AS clusterId, regexp_replace(label, '^[CP]-', 'CL-') AS clusterLabel FROM seqs)"""


_ABUND = """, by_sample AS (SELECT sampleId, clusterId, sum(abundance)::BIGINT AS abundance FROM clones JOIN members USING (clonotypeKey) GROUP BY sampleId, clusterId)
, per AS (SELECT clusterId, sum(abundance)::BIGINT AS abundance_per_cluster FROM by_sample GROUP BY clusterId)
, top AS (SELECT clusterId FROM per ORDER BY abundance_per_cluster DESC, clusterId LIMIT 100)"""

_SHARE = "round(abundance::DOUBLE / nullif(sum(abundance) OVER (PARTITION BY sampleId)::DOUBLE, 0), 9)"


def _rows(chains: int, rule: str = _RULE, trimmed: bool = True) -> str:
    start, end, name = (TRIM_START, TRIM_END, "trim_sequence_") if trimmed else (0, 0, "sequence_")
    each = " UNION ALL ".join(
        f"SELECT clusterId, clonotypeKey, '{name}{k}' AS chain, {trim_report(f'sequence_{k}', start, end)} AS raw FROM members JOIN seqs USING (clonotypeKey)"
        for k in range(chains)
    )
    return f"""{_members(chains, rule)}
, weights AS (SELECT clonotypeKey, CASE WHEN sum(abundance) > 0 THEN sum(abundance)::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM clones GROUP BY clonotypeKey)
, rws AS (SELECT clusterId, clonotypeKey, chain, raw, regexp_replace(raw, '[^A-Za-z]', 'X', 'g') AS seq, weight FROM ({each}) JOIN weights USING (clonotypeKey) WHERE raw <> '')
, dist AS (SELECT clusterId, chain, seq, sum(weight) AS weight FROM rws GROUP BY clusterId, chain, seq)"""


def _profile(chains: int, trimmed: bool = True) -> str:
    return f"""{_rows(chains, trimmed=trimmed)}
, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterId, chain ORDER BY weight DESC, seq) AS rn FROM dist) WHERE rn <= 1000)
, cells AS (SELECT clusterId, chain, seq, weight, unnest(range(length(seq))) AS pos, unnest(string_split(seq, '')) AS residue FROM kept)
, tally AS (SELECT clusterId, chain, pos, residue, sum(weight) AS w FROM cells GROUP BY clusterId, chain, pos, residue)
, cols AS (
  SELECT clusterId, chain, pos, sum(w) AS total, coalesce(sum(w) FILTER (residue = '-'), 0) AS gap_w,
    arg_max(residue, (w, -ascii(residue))) FILTER (residue <> '-') AS best, max(w) FILTER (residue <> '-') AS best_w FROM tally GROUP BY clusterId, chain, pos)
, lens AS (SELECT clusterId, chain, count(*) FILTER (NOT (gap_w / total > 0.5::DOUBLE))::BIGINT AS l_cons FROM cols GROUP BY clusterId, chain)"""


def _symbol(t: float) -> str:
    return (
        "CASE WHEN gap_w / total > 0.5::DOUBLE OR best IS NULL THEN '-' "
        f"WHEN best_w / (total - gap_w) >= {t}::DOUBLE THEN best ELSE 'X' END"
    )


def _consensus(t: float, name: str) -> str:
    return f", {name} AS (SELECT clusterId, chain, replace(string_agg({_symbol(t)}, '' ORDER BY pos), '-', '') AS consensus FROM cols GROUP BY clusterId, chain)"


def _parts(chains: int) -> str:
    joined = " || '====' || ".join(f"coalesce(max(raw) FILTER (chain = 'trim_sequence_{k}'), '')" for k in range(chains))
    return f"""{_profile(chains)}
, d AS (SELECT clusterId, chain, seq, sum(1 - w / total) AS d FROM cells JOIN tally USING (clusterId, chain, pos, residue) JOIN cols USING (clusterId, chain, pos) GROUP BY clusterId, chain, seq)
, parts AS (
  SELECT clusterId, clonotypeKey, max(weight) AS weight, sum(coalesce(d, length(raw))) AS sum_d, sum(greatest(l_cons, length(raw)))::DOUBLE AS sum_norm,
    count(*) FILTER (l_cons > 0) AS n_chains, {joined} AS text
  FROM rws LEFT JOIN d USING (clusterId, chain, seq) JOIN lens USING (clusterId, chain) GROUP BY clusterId, clonotypeKey)
, distances AS (SELECT clusterId, clonotypeKey, round(CASE WHEN sum_norm > 0 THEN least(1.0::DOUBLE, sum_d / sum_norm) ELSE 0.0::DOUBLE END, 9) AS distanceToCentroid FROM parts)
, radius AS (SELECT clusterId, max(distanceToCentroid) AS clusterRadius FROM distances GROUP BY clusterId)
, present AS (SELECT clusterId, count(*) AS n_present FROM lens WHERE l_cons > 0 GROUP BY clusterId)
, medoids AS (
  SELECT clusterId, clonotypeKey AS medoid_key FROM (
    SELECT *, row_number() OVER (PARTITION BY clusterId ORDER BY n_chains < coalesce(n_present, 0), round(sum_d, 9), -weight, text, clonotypeKey) AS r FROM parts LEFT JOIN present USING (clusterId)
  ) WHERE r = 1)"""


def _report(chains: int) -> str:
    full = " || '====' || ".join(trim_report(f"sequence_{k}", TRIM_START, TRIM_END) for k in range(chains))
    trims = ", ".join(f"{trim_report(f'sequence_{k}', TRIM_START, TRIM_END)} AS trim_sequence_{k}" for k in range(chains))
    return f", report AS (SELECT clonotypeKey, sequence_0, {'sequence_1, ' if chains == 2 else ''}{trims}, {full} AS trimmed_fullSequence FROM seqs)"


def _spread(source: str, name: str, prefix: str) -> str:
    picks = ", ".join(f"coalesce(max(consensus) FILTER (chain = 'trim_sequence_{k}'), '') AS {prefix}trim_sequence_{k}" for k in range(2))
    return f", {name} AS (SELECT *, {prefix}trim_sequence_0 || '====' || {prefix}trim_sequence_1 AS {prefix}trimmed_fullSequence FROM (SELECT clusterId, {picks} FROM {source} GROUP BY clusterId))"


_RADIUS = f"(1.0::DOUBLE - {IDENTITY}::DOUBLE)"
#: Pairs of words long enough for an edit within the radius. One edit leaves the first five letters or the last four as they
#: are; words long enough for two are compared with each other.
_WORDS = f"""{_seqs(1)}, clean AS (SELECT min(clonotypeKey) AS key, regexp_replace(sequence_0, '[^A-Za-z]', 'X', 'g') AS seq, length(sequence_0) AS l FROM seqs GROUP BY 2, 3)"""
_ALL_WORDS = f"{_seqs(1)}, wds AS (SELECT clonotypeKey AS key, sequence_0 AS seq FROM seqs)"


def _levenshtein(a: str, b: str) -> str:
    """Edits of lower-case words; levenshtein() counts bytes, so Latin letters beyond ASCII are renamed to ASCII ones that words lack."""
    plain = lambda c: f"translate({c}, 'ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ01234')"
    return f"levenshtein({plain(a)}, {plain(b)})"


def _grams(k: int, mark: str, where: str) -> str:
    most = seeding.LINEAR_SEEDS
    return f"""SELECT key, '{mark}' || gram AS kmer FROM (
    SELECT key, gram, row_number() OVER (PARTITION BY key ORDER BY md5(gram), gram) AS rn FROM (
      SELECT DISTINCT key, substr(seq, unnest(range(1, length(seq) - {k - 2})), {k}) AS gram FROM wds WHERE length(seq) >= {k} AND {where}))
  WHERE rn <= {most}"""


_SEEDS = f"""{_ALL_WORDS}, kept AS (
  {_grams(seeding.LINEAR_K, "", "TRUE")}
  UNION ALL {_grams(seeding.SHORT_K, "short:", f"length(seq) < {seeding.SHORT}")}
)"""

_LINEAR = f"""{_SEEDS}, ranked AS (SELECT kmer, key, seq, (-length(seq), key) AS r FROM kept JOIN wds USING (key))
, centres AS (SELECT kmer, min(r) AS r FROM ranked GROUP BY kmer)
, met AS (SELECT DISTINCT x.key, x.seq, c.key AS centre, c.seq AS c_seq, centres.r FROM ranked x JOIN centres USING (kmer) JOIN wds c ON c.key = centres.r[2] WHERE centres.r < x.r)
, best AS (
  SELECT key, arg_min(centre, r) AS goes FROM met
  WHERE {_levenshtein("seq", "c_seq")}::DOUBLE / greatest(length(seq), length(c_seq))::DOUBLE <= 1.0::DOUBLE - {LINEAR_IDENTITY}::DOUBLE GROUP BY key)"""


def _group(c: str) -> str:
    """Number of the group of a lower-case letter, null for those of none."""
    return "CASE " + " ".join(f"WHEN contains('{g.lower()}', {c}) THEN '{k}'" for k, g in enumerate(GROUPS)) + " END"


def _seed_levels() -> str:
    k, hot, longest = seeding.K, seeding.HOT, seeding.LONGEST
    out = [f"s{k} AS (SELECT key, seq, pos, substr(seq, pos, {k}) AS seed FROM (SELECT key, seq, unnest(range(1, length(seq) - {k - 2})) AS pos FROM wds WHERE length(seq) >= {k}))"]
    for m in range(k, longest + 1):
        if m > k:
            out.append(f"s{m} AS (SELECT key, seq, pos, substr(seq, pos, {m}) AS seed FROM s{m - 1} WHERE seed IN (FROM c{m - 1}) AND pos + {m - 1} <= length(seq))")
        out.append(f"c{m} AS (SELECT seed FROM s{m} GROUP BY seed HAVING count(*) > {hot})")
    each = " UNION ALL ".join(f"SELECT key, pos, seed FROM s{m} WHERE seed NOT IN (FROM c{m})" for m in range(k, longest + 1))
    return ", ".join([*out, f"held AS ({each})"])


_SAME, _LIKE, _OTHER = WHOLE_SCORES
_MASKED = " UNION ALL ".join(
    f"SELECT key, pos, seed, {i} AS i, substr(seed, 1, {i - 1}) || {_group(f'substr(seed, {i}, 1)')} || substr(seed, {i + 1}) AS masked FROM held WHERE length(seed) = {seeding.K}"
    for i in range(1, seeding.K + 1)
)
_NEIGHBOURS = f"""{_ALL_WORDS}, {_seed_levels()}
, masked AS ({_MASKED})
, hits AS (
  SELECT x.key AS a, y.key AS b, x.pos, y.pos - x.pos AS d FROM held x JOIN held y ON x.seed = y.seed AND x.key < y.key
  UNION SELECT x.key, y.key, x.pos, y.pos - x.pos FROM masked x JOIN masked y ON x.i = y.i AND x.masked = y.masked AND x.key < y.key)
, tallied AS (SELECT a, b, max(n) AS n FROM (SELECT a, b, d, count(*) AS n FROM hits GROUP BY a, b, d) GROUP BY a, b)"""

_DIAGONALS = f"""{_ALL_WORDS}, grams AS (SELECT key, pos, substr(seq, pos, {seeding.LINEAR_K}) AS kmer FROM (
  SELECT key, seq, unnest(range(1, length(seq) - {seeding.LINEAR_K - 2})) AS pos FROM wds WHERE length(seq) >= {seeding.LINEAR_K}))
, met AS (SELECT DISTINCT x.key AS a, y.key AS b, y.pos - x.pos AS d FROM grams x JOIN grams y ON x.kmer = y.kmer AND x.key < y.key)
, laid AS (SELECT a, b, substr(wa.seq, 1 + greatest(0, -d)) AS x, substr(wb.seq, 1 + greatest(0, d)) AS y FROM met JOIN wds wa ON wa.key = a JOIN wds wb ON wb.key = b)
, letters AS (SELECT chr(i::INTEGER) AS c, {_group("chr(i::INTEGER)")} AS g FROM range(97, 123) t(i))
, alike AS (SELECT map(list(x.c || y.c), list(CASE WHEN x.c = y.c THEN {_SAME} WHEN x.g = y.g THEN {_LIKE} ELSE {_OTHER} END)) AS m FROM letters x, letters y WHERE x.g IS NOT NULL AND y.g IS NOT NULL)
, scored AS (
  SELECT a, b, greatest(0, list_max(list_reduce(list_prepend([0.0::DOUBLE], list_transform(range(1, least(length(x), length(y)) + 1),
    lambda i: [coalesce(m[x[i] || y[i]], {UNKNOWN})::DOUBLE])), lambda s, v: list_append(s, greatest(s[-1], 0) + v[1])))) AS score FROM laid, alike)
, best AS (SELECT a, b, max(score)::DOUBLE AS score FROM scored GROUP BY a, b)
, ways AS (SELECT a AS query, b AS target, score FROM best UNION ALL SELECT b, a, score FROM best)"""

_PAIRS = f"""{_WORDS}, long AS (SELECT key, seq, l FROM clean WHERE 1.0::DOUBLE / (l + 1)::DOUBLE <= {_RADIUS})
, met AS (
  SELECT a.key AS ka, b.key AS kb, a.seq AS sa, b.seq AS sb FROM long a JOIN long b ON left(a.seq, 5) = left(b.seq, 5) AND abs(a.l - b.l) <= 2 AND a.key < b.key
  UNION SELECT a.key, b.key, a.seq, b.seq FROM long a JOIN long b ON right(a.seq, 4) = right(b.seq, 4) AND abs(a.l - b.l) <= 2 AND a.key < b.key
  UNION SELECT a.key, b.key, a.seq, b.seq FROM long a JOIN long b ON a.l >= 19 AND b.l >= 19 AND a.key < b.key)
, pairs AS (SELECT ka AS a, kb AS b, levenshtein(sa, sb)::BIGINT AS distance FROM met WHERE levenshtein(sa, sb)::DOUBLE / greatest(length(sa), length(sb))::DOUBLE <= {_RADIUS})
, ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs)"""
_BODY = "upper(left(regexp_replace(to_base64(unhex(sha256(plurality_centroid_trimmed_fullSequence))), '[^A-Za-z]', '', 'g'), 5))"
_LABELLED = f""", bodies AS (SELECT *, CASE WHEN length(plurality_centroid_trimmed_fullSequence) > 0 THEN {_BODY} END AS body FROM wide)
, ranked AS (SELECT *, CASE WHEN body IS NOT NULL THEN dense_rank() OVER (PARTITION BY body ORDER BY plurality_centroid_trimmed_fullSequence) END AS rnk FROM bodies)
, labelled AS (SELECT *, CASE WHEN body IS NOT NULL THEN 'PC-' || body || CASE WHEN rnk > 1 THEN '-' || rnk ELSE '' END END AS peptideLabel FROM ranked)"""
_PLURALITY = _profile(2) + _consensus(0.0, "plurality") + _spread("plurality", "wide", "plurality_centroid_") + _LABELLED
_CTS = (
    _parts(2) + _consensus(0.6, "con") + _spread("con", "wide", "centroid_") + _report(2)
    + """, cts AS (
  SELECT s.clusterId, clusterLabel, size, o.sequence_0, o.sequence_1, o.trim_sequence_0, o.trim_sequence_1, o.trimmed_fullSequence,
    centroid_trim_sequence_0, centroid_trim_sequence_1, centroid_trimmed_fullSequence, r.sequence_0 AS reference_centroid_sequence_0, r.sequence_1 AS reference_centroid_sequence_1,
    r.trim_sequence_0 AS reference_centroid_trim_sequence_0, r.trim_sequence_1 AS reference_centroid_trim_sequence_1, r.trimmed_fullSequence AS reference_centroid_trimmed_fullSequence
  FROM sizes s LEFT JOIN labels USING (clusterId) LEFT JOIN report o ON o.clonotypeKey = s.clusterId LEFT JOIN wide w ON w.clusterId = s.clusterId
  LEFT JOIN medoids m ON m.clusterId = s.clusterId LEFT JOIN report r ON r.clonotypeKey = m.medoid_key)"""
)


def _coverage(mode: int) -> str:
    q, t, x = "(length(b) - 2)::DOUBLE", "(length(a) - 2)::DOUBLE", "0.95::DOUBLE"
    return {
        0: f"least({q}, {t}) / {q} >= {x} AND least({q}, {t}) / {t} >= {x}",
        1: f"least({q}, {t}) / {t} >= {x}",
        2: f"least({q}, {t}) / {q} >= {x}",
        3: f"{t} <= {q} AND {t} / {q} >= {x}",
        4: f"{q} <= {t} AND {q} / {t} >= {x}",
        5: f"least({q}, {t}) / greatest({q}, {t}) >= {x}",
    }[mode]


# top_clusters of the query's one-chain families come from the one-chain members, the radius from the two-chain ones
_TOP1 = f"WITH {_members(1)}{_ABUND}"

ORACLES = {
    "clone_table": f"WITH {_clones(2)} SELECT * FROM clones",
    "seq_table": f"WITH {_seqs(2)} SELECT clonotypeKey, sequence_0, sequence_1 FROM seqs",
    "seq_trim": f"WITH {_seqs(1)} SELECT clonotypeKey, {trim_key('sequence_0', 2, 5)} AS key_side, {trim_report('sequence_0', 2, 5)} AS report_side FROM seqs",
    "full_sequence_concat": f"""WITH {_seqs(2)} SELECT clonotypeKey, sequence_0 || '====' || sequence_1 AS fullSequence,
  {trim_report('sequence_0', 1, 1)} || '====' || {trim_report('sequence_1', 1, 1)} AS trimmed_fullSequence,
  ({trim_key('sequence_0', 1, 1)}) || '====' || ({trim_key('sequence_1', 1, 1)}) AS per_chain, {trim_key("(sequence_0 || '====' || sequence_1)", 1, 1)} AS as_one FROM seqs""",
    "cluster_label_regex": f"WITH {_clones(1)} SELECT DISTINCT clonotypeKey, regexp_replace(clonotypeKeyLabel, '^[CP]-', 'CL-') AS clusterLabel FROM clones",
    "sanitize_sequences": f"WITH {_seqs(1)} SELECT clonotypeKey, regexp_replace(sequence_0, '[^A-Za-z]', 'X', 'g') AS sanitized FROM seqs",
    "dedup_mapping": f"WITH {_keyed(1)} SELECT * FROM mapping",
    "fasta_diagnostics": f"""WITH {_keyed(1)} SELECT count(*)::BIGINT AS n_sequences, count(DISTINCT sequence)::BIGINT AS n_distinct, min(length(sequence))::INT AS min_length,
  max(length(sequence))::INT AS max_length, round(avg(length(sequence)), 6) AS mean_length, count(*) FILTER (length(sequence) = 0)::BIGINT AS n_empty,
  count(*) FILTER (length(sequence) < 6)::BIGINT AS n_short FROM keyed""",
    "input_empty_flag": f"WITH {_clones(1)} SELECT CASE WHEN count(*) = 0 THEN 'empty' ELSE 'notEmpty' END AS inputState, count(*)::BIGINT AS n_rows FROM clones",
    "min_peptide_length": f"WITH {_clones(1)} SELECT min(length(sequence_0))::BIGINT AS min_len FROM clones",
    "modal_length_share": " UNION ALL ".join(
        f"""(WITH {_clones(2)}, l AS (SELECT length({trim_report(f'sequence_{k}', TRIM_START, TRIM_END)}) AS l, count(*) AS c FROM clones GROUP BY 1 HAVING l > 0)
  SELECT coalesce(sum(c), 0)::BIGINT AS n, coalesce(arg_max(l, (c, -l)), 0)::BIGINT AS modal_length, coalesce(max(c)::DOUBLE / sum(c)::DOUBLE, 0.0::DOUBLE) AS modal_share, {k}::INT AS chain FROM l)"""
        for k in range(2)
    ),
    "clonotype_weights": f"WITH {_clones(1)} SELECT clonotypeKey, CASE WHEN sum(abundance) > 0 THEN sum(abundance)::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM clones GROUP BY clonotypeKey",
    "unit_weights": f"WITH {_clones(1)} SELECT DISTINCT clonotypeKey, 1.0::DOUBLE AS weight FROM clones",
    "cluster_expand_size": f"WITH {_members()} SELECT clusterId, clonotypeKey, size FROM members JOIN sizes USING (clusterId)",
    "cluster_labels": f"WITH {_members()} SELECT clusterId, clonotypeKey, clusterLabel FROM members LEFT JOIN labels USING (clusterId)",
    "abundances": f"WITH {_members()}{_ABUND} SELECT *, {_SHARE} AS abundance_normalized FROM by_sample",
    "abundances_per_cluster": f"""WITH {_members()}{_ABUND} SELECT clusterId, abundance_per_cluster,
  round(abundance_per_cluster::DOUBLE / (SELECT sum(abundance_per_cluster) FROM per)::DOUBLE, 9) AS abundance_fraction_per_cluster FROM per""",
    "top_clusters": f"{_TOP1} SELECT clusterId, abundance_per_cluster FROM per JOIN top USING (clusterId)",
    "abundances_top": f"{_TOP1} SELECT b.* FROM (SELECT *, {_SHARE} AS abundance_normalized FROM by_sample) b JOIN top USING (clusterId)",
    "cluster_radius_top": f"WITH {_parts(2)}{_ABUND} SELECT radius.* FROM radius JOIN top USING (clusterId)",
    "clone_to_cluster": f"WITH {_members()} SELECT clusterId, clonotypeKey, clusterLabel, 1::BIGINT AS link FROM members LEFT JOIN labels USING (clusterId)",
    "tsv_round_trip": f"""WITH {_clones(1)}
SELECT sampleId, count(*)::BIGINT AS n_rows, sum(abundance)::BIGINT AS abundance, count(*) FILTER (length(sequence_0) % 3 = 0)::BIGINT AS n_unlabelled,
  sum(length(sequence_0))::BIGINT AS n_letters, min(clonotypeKey) AS first_key, max(clonotypeKey) AS last_key FROM clones GROUP BY sampleId""",
    "string_import": f"WITH {_clones(1)} SELECT sampleId, clonotypeKey, abundance, sequence_0 FROM clones",
    "cluster_list_scan": f"WITH {_members()} SELECT clusterId, clonotypeKey FROM clusters",
    "fasta_round_trip": f"WITH {_keyed(1)} SELECT clonotypeKey, sequence FROM reps",
    "content_record": f"""WITH {_keyed(1)}
SELECT count(*)::BIGINT AS n_sequences, count(DISTINCT sequence)::BIGINT AS n_distinct, min(length(sequence))::INTEGER AS min_length, max(length(sequence))::INTEGER AS max_length FROM keyed""",
    "chain_order": f"""WITH {_seqs(1)}, cut AS (SELECT clonotypeKey, list_transform(range(12), lambda k: substr(sequence_0, 2 * k + 1, 2)) AS parts FROM seqs)
SELECT clonotypeKey, array_to_string(parts, '====') AS fullSequence, array_to_string(list_transform(parts, lambda p: {trim_report('p', 0, 1)}), '====') AS trimmed_fullSequence FROM cut""",
    "alignment_model": f"""WITH {_clones(1)}, lengths AS (SELECT sampleId, length(word) AS l, count(*) AS c FROM counted GROUP BY sampleId, length(word))
, shares AS (SELECT sampleId, max(c)::DOUBLE / sum(c)::DOUBLE AS share FROM lengths GROUP BY sampleId)
SELECT sampleId, CASE WHEN peptide AND share >= least THEN 'ungapped' ELSE 'gapped' END AS model, peptide, least, round(share, 9) AS modal_share
FROM shares, (VALUES (TRUE), (FALSE)) p(peptide), (VALUES (0.1::DOUBLE), (0.9::DOUBLE)) t(least)""",
    "linear_seeds": f"WITH {_SEEDS} SELECT key, kmer FROM kept",
    "linear_time_clusters": f"""WITH {_LINEAR}
SELECT CASE WHEN goes IS NOT NULL AND goes NOT IN (SELECT key FROM best) THEN goes ELSE key END AS clusterId, key AS clonotypeKey FROM wds LEFT JOIN best USING (key)""",
    "neighbour_pairs": f"""WITH {_NEIGHBOURS}
SELECT a, count(*)::BIGINT AS n_pairs, min(b) AS first_b, max(b) AS last_b FROM tallied JOIN wds x ON x.key = a JOIN wds y ON y.key = b
WHERE n >= least({seeding.HITS}, length(x.seq) - {seeding.K - 1}, length(y.seq) - {seeding.K - 1}) GROUP BY a""",
    "diagonal_candidates": f"""WITH {_DIAGONALS}
SELECT query, count(*)::BIGINT AS n_targets, sum(score)::DOUBLE AS total_score, arg_min(target, (-score, target)) AS best_target, max(score) AS best_score
FROM (FROM ways QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, target) <= {seeding.TOP}) GROUP BY query""",
    "levenshtein_pairs": f"WITH {_PAIRS} SELECT a, b, distance FROM pairs",
    "connected_components": f"""WITH RECURSIVE {_PAIRS}, reach AS (
  SELECT a AS node, a AS seen FROM ways UNION SELECT reach.node, ways.b FROM reach JOIN ways ON ways.a = reach.seen
) SELECT coalesce(c, key) AS clusterId, key AS clonotypeKey FROM clean LEFT JOIN (SELECT node, min(seen) AS c FROM reach GROUP BY node) ON node = key""",
    "one_hop_clusters": f"""WITH {_PAIRS}, least AS (SELECT key, least(key, coalesce(min(b), key)) AS goes FROM clean LEFT JOIN ways ON a = key GROUP BY key)
SELECT CASE WHEN h.key IS NOT NULL THEN l.goes ELSE l.key END AS clusterId, l.key AS clonotypeKey FROM least l LEFT JOIN least h ON h.key = l.goes AND h.key = h.goes""",
    "kmer_candidates": f"""WITH {_WORDS}, grams AS (
  SELECT DISTINCT key, l, unnest(list_transform(range(1, l - 3), lambda i: substr(seq, i, 5))) AS kmer FROM clean WHERE l >= 5)
SELECT kmer, count(*)::BIGINT AS n, arg_min(key, (-l, key)) AS centre FROM grams GROUP BY kmer""",
    "coverage_modes": f"WITH {_PAIRS} SELECT a, b, {', '.join(f'{_coverage(m)} AS mode_{m}' for m in range(6))} FROM pairs",
    "weighted_distinct_members": f"WITH {_rows(2)} SELECT * FROM dist",
    "capped_members": f"WITH {_rows(1)} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterId, chain ORDER BY weight DESC, seq) AS rn FROM dist) WHERE rn <= 20",
    "column_tally": f"WITH {_profile(1)} SELECT * FROM tally",
    "consensus_centroid": f"WITH {_profile(2)}{_consensus(0.6, 'con')} SELECT clusterId, chain, consensus, l_cons FROM con JOIN lens USING (clusterId, chain)",
    "plurality_centroid": f"WITH {_profile(2)}{_consensus(0.0, 'con')} SELECT clusterId, chain, consensus AS plurality, length(replace(consensus, '-', ''))::BIGINT AS plurality_length FROM con",
    "profile_distance": f"WITH {_parts(2)} SELECT * FROM distances",
    "cluster_radius": f"WITH {_parts(2)} SELECT * FROM radius",
    "medoid_reference": f"WITH {_parts(2)}{_report(2)} SELECT clusterId, medoid_key, trimmed_fullSequence AS reference_centroid_trimmed_fullSequence FROM medoids LEFT JOIN report ON clonotypeKey = medoid_key",
    "peptide_label": f"WITH {_PLURALITY} SELECT s.clusterId, plurality_centroid_trimmed_fullSequence, peptideLabel, s.clusterId AS clusterIdLink, 1::BIGINT AS link FROM sizes s LEFT JOIN labelled USING (clusterId)",
    "cluster_to_seq": f"WITH {_CTS} SELECT * FROM cts",
    "trimmed_sequences": f"WITH {_seqs(2)}{_report(2)} SELECT clonotypeKey, trimmed_fullSequence, trim_sequence_0, trim_sequence_1 FROM report",
    "anonymize_roundtrip": f"WITH {_clones(1)}, ids AS (SELECT sampleId, 'S' || row_number() OVER (ORDER BY sampleId) AS anonymised_id FROM (SELECT DISTINCT sampleId FROM clones)) SELECT sampleId, anonymised_id, sum(abundance)::BIGINT AS abundance FROM clones JOIN ids USING (sampleId) GROUP BY ALL",
    "cluster_size_histogram": f"""WITH {_members()}, t AS (SELECT max(size)::DOUBLE / 30.0::DOUBLE AS step FROM sizes)
SELECT least(floor((size - 1) / step)::BIGINT + 1, 30)::BIGINT AS bin, count(*)::BIGINT AS n, round(max((least(floor((size - 1) / step)::BIGINT + 1, 30) - 1) * step + 1.0::DOUBLE), 6) AS lower FROM sizes, t GROUP BY 1""",
    "bubble_view": f"{_TOP1} SELECT sampleId, clusterId, abundance, size FROM by_sample JOIN top USING (clusterId) JOIN sizes USING (clusterId) WHERE size >= 3",
    "msa_view": f"""WITH {_parts(2)}{_report(2)}, chosen AS (SELECT clusterId FROM sizes ORDER BY size DESC, clusterId LIMIT 10)
SELECT clusterId, clonotypeKey, trim_sequence_0, trim_sequence_1, distanceToCentroid FROM members JOIN chosen USING (clusterId) LEFT JOIN report USING (clonotypeKey) LEFT JOIN distances USING (clusterId, clonotypeKey)""",
    "centroid_dataset": f"""WITH {_PLURALITY}{_ABUND} SELECT sampleId, clusterId AS variantKey, abundance, plurality_centroid_trimmed_fullSequence AS sequence,
  length(plurality_centroid_trimmed_fullSequence)::BIGINT AS sequenceLength, peptideLabel AS label FROM by_sample JOIN sizes USING (clusterId) LEFT JOIN labelled USING (clusterId)""",
    "clusters_view": f"""WITH {_parts(2)}{_ABUND} SELECT s.clusterId, clusterLabel, size, clusterRadius, abundance_per_cluster,
  round(abundance_per_cluster::DOUBLE / (SELECT sum(abundance_per_cluster) FROM per)::DOUBLE, 9) AS abundance_fraction_per_cluster
FROM sizes s LEFT JOIN labels USING (clusterId) LEFT JOIN radius USING (clusterId) LEFT JOIN per USING (clusterId)""",
}
# singletons against the larger families' representatives, by brute force over words long enough for an edit
ORACLES["reassign_singletons"] = f"""WITH {_members(1)}{_report(1)}
, plain AS (SELECT clonotypeKey, regexp_replace(trimmed_fullSequence, '[^A-Za-z]', 'X', 'g') AS x FROM report WHERE trimmed_fullSequence <> '')
, n AS (SELECT clusterId, count(*) AS rep_size FROM clusters GROUP BY clusterId)
, s AS (SELECT clonotypeKey AS m, x FROM clusters JOIN n USING (clusterId) JOIN plain USING (clonotypeKey) WHERE rep_size = 1)
, c AS (SELECT clusterId, rep_size, x AS y FROM n JOIN plain ON clonotypeKey = clusterId WHERE rep_size > 1)
, near AS (
  SELECT m, clusterId, rep_size, levenshtein(x, y)::DOUBLE / greatest(length(x), length(y))::DOUBLE AS d FROM (
    SELECT * FROM s JOIN c ON left(x, 5) = left(y, 5) AND abs(length(x) - length(y)) <= 2 WHERE length(x) >= 10 AND length(y) >= 10
    UNION SELECT * FROM s JOIN c ON right(x, 4) = right(y, 4) AND abs(length(x) - length(y)) <= 2 WHERE length(x) >= 10 AND length(y) >= 10
    UNION SELECT * FROM s JOIN c ON length(x) >= 19 AND length(y) >= 19)
  WHERE levenshtein(x, y)::DOUBLE / greatest(length(x), length(y))::DOUBLE <= {_RADIUS}
  UNION ALL SELECT m, clusterId, rep_size, 0.0::DOUBLE FROM s JOIN c ON x = y WHERE length(x) < 10)
, best AS (SELECT m, arg_min(clusterId, (d, -rep_size, clusterId)) AS new_id FROM near GROUP BY m)
SELECT coalesce(new_id, clusterId) AS clusterId, clonotypeKey FROM clusters LEFT JOIN best ON m = clonotypeKey"""
ORACLES["cluster_to_seq_top"] = f"""WITH {_CTS}, top AS (
  SELECT clusterId FROM ({_TOP1.replace('WITH ', 'WITH ', 1)} SELECT clusterId FROM top)
) SELECT cts.* FROM cts JOIN top USING (clusterId)"""
ORACLES["clone_table_join"] = ORACLES["clone_table"]
ORACLES["key_uniqueness"] = f"""WITH {_clones(1)} SELECT count(*)::BIGINT AS n_rows, count(DISTINCT (sampleId, clonotypeKey))::BIGINT AS n_keys,
  count(*) = count(DISTINCT (sampleId, clonotypeKey)) AS is_unique FROM clones"""
ORACLES["distance_relation"] = f"""WITH {_parts(2)} SELECT m.clonotypeKey, m.clusterId, s.label AS clonotypeKeyLabel, clusterLabel, coalesce(distanceToCentroid, 0.0::DOUBLE) AS distanceToCentroid
FROM members m JOIN seqs s USING (clonotypeKey) LEFT JOIN labels l ON l.clusterId = m.clusterId LEFT JOIN distances d ON d.clusterId = m.clusterId AND d.clonotypeKey = m.clonotypeKey"""
_LENGTHS = ", ".join(f"length(replace(plurality_centroid_trim_sequence_{k}, '-', ''))::BIGINT AS plurality_centroid_length_trim_sequence_{k}" for k in range(2))
ORACLES["plurality_relation"] = f"""WITH {_PLURALITY} SELECT s.clusterId, clusterLabel, plurality_centroid_trim_sequence_0, plurality_centroid_trim_sequence_1,
  plurality_centroid_trimmed_fullSequence, {_LENGTHS}, s.clusterId AS clusterIdLink, 1::BIGINT AS link, peptideLabel
FROM sizes s LEFT JOIN labels USING (clusterId) LEFT JOIN labelled USING (clusterId)"""
_NULLS = ", ".join(f"NULL::VARCHAR AS plurality_centroid_trim_sequence_{k}, NULL::BIGINT AS plurality_centroid_length_trim_sequence_{k}" for k in range(2))
ORACLES["plurality_unwanted"] = f"""WITH {_members(2)} SELECT clusterId, clusterLabel, {_NULLS}, NULL::VARCHAR AS plurality_centroid_trimmed_fullSequence,
  clusterId AS clusterIdLink, 1::BIGINT AS link, NULL::VARCHAR AS peptideLabel FROM sizes LEFT JOIN labels USING (clusterId)"""
_UNTRIMMED = f"WITH {_profile(2, False)}{_consensus(0.6, 'con')}"
ORACLES["centroid_untrimmed"] = f"{_UNTRIMMED} SELECT clusterId, chain, consensus, l_cons FROM con JOIN lens USING (clusterId, chain)"
_BOTH = ", ".join(f"coalesce(max(consensus) FILTER (chain = 'sequence_{k}'), '') AS centroid_sequence_{k}" for k in range(2))
ORACLES["cluster_to_seq_full"] = f"""WITH {_CTS}, untrimmed AS (SELECT * FROM ({_UNTRIMMED} SELECT clusterId, {_BOTH} FROM con GROUP BY clusterId))
SELECT cts.*, centroid_sequence_0, centroid_sequence_1 FROM cts LEFT JOIN untrimmed USING (clusterId)"""
ORACLES["padded_absent_columns"] = f"""WITH {_rows(1, 'left(sequence, 5)')}
, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterId, chain ORDER BY weight DESC, seq) AS rn FROM dist) WHERE rn <= 1000)
, wide AS (SELECT *, max(length(seq)) OVER (PARTITION BY clusterId, chain) AS width FROM kept)
, cells AS (SELECT clusterId, chain, weight, unnest(range(width)) AS pos, unnest(string_split(rpad(seq, width::INT, '-'), '')) AS residue FROM wide)
, tally AS (SELECT clusterId, chain, pos, residue, sum(weight) AS w FROM cells GROUP BY clusterId, chain, pos, residue)
, cols AS (
  SELECT clusterId, chain, pos, sum(w) AS total, coalesce(sum(w) FILTER (residue = '-'), 0) AS gap_w,
    arg_max(residue, (w, -ascii(residue))) FILTER (residue <> '-') AS best, max(w) FILTER (residue <> '-') AS best_w FROM tally GROUP BY clusterId, chain, pos)
, told AS (SELECT *, gap_w / total > 0.2::DOUBLE AS absent FROM cols)
SELECT clusterId, chain, count(*)::BIGINT AS n_columns, count(*) FILTER (absent)::BIGINT AS n_absent, count(*) FILTER (NOT absent)::BIGINT AS l_cons,
  string_agg(CASE WHEN absent OR best IS NULL THEN '-' WHEN best_w / (total - gap_w) >= 0.6::DOUBLE THEN best ELSE 'X' END, '' ORDER BY pos) AS consensus
FROM told GROUP BY clusterId, chain"""
ORACLES["dropped_members"] = f"WITH {_rows(1)} SELECT clusterId, chain, count(*)::BIGINT AS n_members, count(*)::BIGINT - 20 AS n_dropped FROM dist GROUP BY clusterId, chain HAVING count(*) > 20"
ORACLES["reassignment_sample"] = ORACLES["reassign_singletons"].split(", best AS (")[0] + """
SELECT m AS member_key, arg_min(clusterId, (d, -rep_size, clusterId)) AS new_clusterId, round(min(d), 9) AS norm_dist, arg_min(rep_size, (d, -rep_size, clusterId))::BIGINT AS rep_size
FROM near GROUP BY m ORDER BY norm_dist, member_key LIMIT 10"""
