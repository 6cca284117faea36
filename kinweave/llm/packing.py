"""Packing by lexical retrieval: sequences of neighbouring documents.

Documents are dealt to shards of about SHARD_BYTES of text; which shard follows from a min-hash of a document's words,
so that like documents tend to meet, and large groups of them are split by a hash of the row. A document counts for
OVERHEAD bytes beside its text, which bounds the documents of a shard. Each shard holds a BM25 inverted index (hashed lower-cased words; document frequencies and mean length from all documents). The first unused
document is a seed: it fills windows of `window` tokens, and into the room of its last one go its best unused
neighbours that fit in whole, by score; what room is left is filled by cutting the best neighbour, whose rest is the
next seed. Only the last sequence of a shard can be short.

Tokens: the ids that `tokenizers` gives for the vocabulary file with add_special_tokens=False, then id END. As there, the
string of an added token in a text is that token. The encoder is built from the vocabulary itself, its added tokens
included, and takes a quarter of the time; half of that again where no white space has to be looked ahead of.

Nulls: a null text counts as empty and gives the id END alone; a null doc_id is kept. Repeated rows are packed each.
Ties in score go to the row that comes first by doc_id and hash of the text. A very long text is a shard of its own,
fills many windows, and is hashed in chunks; its ids are held whole. An empty table gives no pieces. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import blocks, mix, word_hashes

WINDOW, END, SHARD_BYTES, OVERHEAD = 2048, 1, 4 << 20, 256
#: Buckets of hashed words, and of the min-hashes by which shards are planned; both tables are bounded by these.
TERMS, ROUTES = 1 << 16, 1 << 16
K1, B = 1.2, 0.75
#: Words are hashed in blocks of this many bytes, which stay in the cache.
BLOCK = 1 << 19
#: Characters that are encoded at once.
PART = 1 << 18
_BETWEEN = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")
#: White space as the vocabulary's pattern has it; a run of it gives its last character to what comes next.
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN, _RUN_END = re.compile(f"[{_SPACES}]{{2}}"), re.compile(f"(?<=[{_SPACES}])(?=[{_SPACES}][^{_SPACES}])")
_AHEAD = r"|\s+(?!\S)"
_U = np.uint64
_ENCODERS: dict[tuple[str, bool], object] = {}


def encoder(path: str, ahead: bool = True):
    """The encoder of a byte-level BPE vocabulary in the format of `tokenizers`, made once a process.

    Without looking ahead it is right for texts that hold no added token and no white space of two or more before a word.
    """
    if (path, ahead) not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        added = {t["content"]: t["id"] for t in told["added_tokens"]}
        # the vocabulary writes a byte that isn't printable as the next free code point from 256 on
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in told["model"]["vocab"].items() if token not in added}
        pattern = public_tokenizers.PATTERN if ahead else public_tokenizers.PATTERN.replace(_AHEAD, "")
        _ENCODERS[path, ahead] = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[path, ahead]


def token_ids(text: str, path: str) -> np.ndarray:
    """The ids of a text and END. Long texts are encoded in parts, cut before a blank between letters, where no token goes on."""
    made, own, at = encoder(path, False), [], 0
    # an added token ends the white space before it, so texts that hold one are taken as they are
    as_is = any(token in text for token in made.special_tokens_set)
    made = encoder(path) if as_is else made
    while at < len(text):
        cut = _BETWEEN.search(text, at + PART) if len(text) - at > PART else None
        end = cut.start() if cut else len(text)
        part = text if end - at == len(text) else text[at:end]
        for piece in _RUN_END.split(part) if not as_is and _RUN.search(part) else [part]:
            own.append(made.encode_to_numpy(piece, allowed_special="all"))
        at = end
    return np.concatenate([*own, np.array([END], dtype=np.uint32)])


def _words(block: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and bucket of every word, and each text's route."""
    hashes, first = word_hashes(block)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(block)), n)
    least = np.full(len(block), (1 << 64) - 1, dtype=np.uint64)
    if len(hashes):
        some = np.flatnonzero(n)
        least[some] = np.minimum.reduceat(hashes, first[:-1][some])
    return doc, (hashes >> _U(48)).astype(np.int64), (mix(least) >> _U(48)).astype(np.int32)


def _narrow(values: np.ndarray, end: int) -> np.ndarray:
    """Numbers below `end` in the least type that holds them, which sorts faster."""
    return values.astype(np.uint16 if end <= 1 << 16 else np.uint32 if end <= 1 << 32 else np.int64)


def _document_frequency(doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
    """In how many of n documents each bucket occurs."""
    pairs = _narrow(doc * TERMS + bucket, n * TERMS)
    pairs.sort()
    new = np.ones(len(pairs), dtype=bool)
    np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
    return np.bincount(pairs[new].astype(np.int64) % TERMS, minlength=TERMS)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: kind, key, n. Kinds: document frequency by bucket, bytes by route, and documents and words in all."""
    frequency, route_bytes, totals = np.zeros(TERMS, np.int64), np.zeros(ROUTES, np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for _, block in blocks(batch.column("text").to_pylist(), BLOCK):
            doc, bucket, route = _words(block)
            frequency += _document_frequency(doc, bucket, len(block))
            np.add.at(route_bytes, route, [len(t) + OVERHEAD for t in block])
            totals += (len(block), len(doc))
    for kind, counts in enumerate((frequency, route_bytes, totals)):
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["kind", "key", "n"])


def plan_shards(route_bytes: np.ndarray, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """For each route its first shard and over how many shards it is split; light routes share one."""
    splits = np.maximum(1, -(-route_bytes // shard_bytes))
    first = np.zeros(len(route_bytes), dtype=np.int64)
    shard, held = 0, 0
    for k in range(len(route_bytes)):
        if held and held + route_bytes[k] > shard_bytes:
            shard, held = shard + 1, 0
        first[k] = shard
        held += route_bytes[k]
        if splits[k] > 1:
            shard, held = shard + splits[k], 0
    return first, splits


class Index:
    """BM25 over the documents of one shard."""

    def __init__(self, block_words: list[np.ndarray], idf: np.ndarray, mean_words: float):
        n = len(block_words)
        doc = np.repeat(np.arange(n), [len(w) for w in block_words])
        where, tf = np.unique(_narrow(np.concatenate([np.empty(0, np.int64), *block_words]) * n + doc, TERMS * n), return_counts=True)
        where = where.astype(np.int64)
        self.bucket, self.doc = where // n, where % n
        length = np.array([len(w) for w in block_words])[self.doc]
        self.weight = idf[self.bucket] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_words))
        self.n = n
        own = np.argsort(_narrow(self.doc, n), kind="stable")
        self.own_buckets = np.split(self.bucket[own], np.cumsum(np.bincount(self.doc, minlength=n))[:-1])
        self.start = np.searchsorted(self.bucket, np.arange(TERMS + 1))

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document for the words of `seed`."""
        terms = self.own_buckets[seed]
        begin, count = self.start[terms], self.start[terms + 1] - self.start[terms]
        if not len(terms):
            return np.zeros(self.n)
        at = np.arange(count.sum()) + np.repeat(begin - np.cumsum(count) + count, count)
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def fill(lengths: list[int], index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard's documents."""
    out, unused, first = [], np.ones(len(lengths), dtype=bool), 0
    size = np.array(lengths, dtype=np.int64)
    sequence, offset = 0, 0
    seed, start = None, 0
    while True:
        if seed is None:
            while first < len(lengths) and not unused[first]:
                first += 1
            if first == len(lengths):
                return out
            seed, start = first, 0
            unused[seed] = False
        while start < lengths[seed]:
            n = min(lengths[seed] - start, window - offset)
            out.append((seed, start, n, sequence, offset))
            start, offset = start + n, offset + n
            if offset == window:
                sequence, offset = sequence + 1, 0
        of, seed = seed, None
        if not offset:
            continue
        left = np.flatnonzero(unused)
        ranked = left[np.argsort(-index.scores(of)[left], kind="stable")]
        # room only shrinks, so who doesn't fit once never will
        fits = ranked[size[ranked] <= window - offset]
        while len(fits):
            d = int(fits[0])
            unused[d] = False
            out.append((d, 0, lengths[d], sequence, offset))
            offset += lengths[d]
            fits = fits[1:][size[fits[1:]] <= window - offset]
        if offset == window:
            sequence, offset = sequence + 1, 0
            continue
        rest = ranked[unused[ranked]]
        if len(rest):
            seed, start = int(rest[0]), 0
            unused[seed] = False


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Pieces of all documents, with their ids (little-endian unsigned 32-bit); path: the vocabulary."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = rows.select("text").mapInArrow(_statistics, "kind int, key int, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    kind, key, n = (counts.column(c).to_numpy() for c in ("kind", "key", "n"))
    frequency, route_bytes, totals = np.zeros(TERMS), np.zeros(ROUTES, np.int64), np.zeros(2)
    for which, target in enumerate((frequency, route_bytes, totals)):
        target[key[kind == which]] = n[kind == which]
    idf = np.log1p((totals[0] - frequency + 0.5) / (frequency + 0.5))
    mean_words = max(1.0, totals[1] / max(1.0, totals[0]))
    first, splits = plan_shards(route_bytes, shard_bytes)
    sc = spark.sparkContext
    shared_plan, shared_idf = sc.broadcast((first, splits)), sc.broadcast(idf)

    @F.pandas_udf("long")
    def shard_of(text, row_hash):
        import pandas as pd

        first, splits = shared_plan.value
        route = np.concatenate([np.empty(0, np.int32), *[_words(block)[2] for _, block in blocks(list(text), BLOCK)]])
        return pd.Series(first[route] + row_hash.to_numpy() % splits[route])

    def pack_shard(shard: int, members: list[tuple[int | None, str]]) -> pa.RecordBatch:
        ids = [token_ids(text, path) for _, text in members]
        words = [w for _, block in blocks([text for _, text in members], BLOCK) for w in _split_words(block)]
        pieces = fill([len(x) for x in ids], Index(words, shared_idf.value, mean_words), window)
        cut = [ids[d][s : s + k].astype("<u4").tobytes() for d, s, k, _, _ in pieces]
        d, s, k, q, o = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([members[i][0] for i in d], pa.int64()), pa.array(s), pa.array(k), pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                pa.array([len(ids[i]) for i in d], pa.int64()), pa.array((np.int64(shard) << 32) + q), pa.array(o), pa.array(cut, pa.binary()),
            ],
            names=[c.split()[0] for c in PIECE.split(", ")],
        )

    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members = None, []
        for batch in batches:
            for shard, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "text")), strict=True):
                if shard != at and members:
                    yield pack_shard(at, members)
                    members = []
                at = shard
                members.append((doc_id, text))
        if members:
            yield pack_shard(at, members)

    dealt = rows.withColumn("shard", shard_of("text", F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1))))
    n_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = dealt.repartition(n_partitions, "shard").sortWithinPartitions("shard", "doc_id", F.xxhash64("text"))
    return placed.select("shard", "doc_id", "text").mapInArrow(pack_all, PIECE)


def _split_words(block: list[bytes]) -> list[np.ndarray]:
    doc, bucket, _ = _words(block)
    return np.split(bucket, np.cumsum(np.bincount(doc, minlength=len(block)))[:-1])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")
