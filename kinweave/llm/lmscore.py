"""Language-model scoring with a weighted backoff automaton of smoothed n-grams.

P(w | h) = (c(h, w) + MU * P(w | h')) / (c(h) + MU), where h' is the context h without its oldest word, down to
P(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)); each sums to one over the vocabulary and one unknown word. As an automaton: the
contexts of up to `order` - 1 words are its states, the start of a text among them; every n-gram seen in training is an
arc of the state of its context; a state without an arc for a word takes its failure arc, of weight MU / (c(h) + MU), to
the state of the next shorter context, and so on down to the root, which has an arc for every word. A text is read once
from left to right: the state is carried, weights are added up as log10, and the end of the text is read like a word.

Counts grow with the corpus, so no task and no driver holds the model. Texts are worked on as blocks of token numbers,
made from the table once to ask and once to score; a table that gives other rows the second time is noticed and raises
an error. Each block asks for the training counts of its own words and n-grams, by hashed keys that are dealt to
shards by ranges; each request also brings the block's own training counts, so one shuffle both trains and asks. A
shard adds up the counts of its keys and answers every block. With the answers a block has the part of the automaton
that its texts can reach. Requests of a key: one a block, however frequent it is. A request row holds all keys of a block
that fall to a shard; shards take SHARD_KEYS keys each, many blocks' worth, so rows are few beside keys, and never more.

Nulls: a null text counts as empty, and has one token, the end. A null doc_id is in training. Words are told apart by
64-bit hashes, n-grams by as many bits as leave a chance of 2^-24 that a key of the corpus meets another. Equal texts
get equal scores, and repeated rows count as often as they occur. Very long texts are blocks of their own. Without
training texts all counts are 0. An empty table gives an empty result. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .shingles import SPACE, mix, word_hashes

ORDER = 3
#: Weight of the estimate by the next shorter context, in occurrences, for contexts of one word, two words, ...; the last
#: holds for longer ones. Chosen on held-out documents at two sizes.
MU = (1500.0, 30.0)
BLOCK_BYTES = 3 << 20
#: Keys a shard, with those that several blocks ask for counted each time; and shards that small corpora have at most.
SHARD_KEYS, SHARDS = 8_000_000, 64
_U = np.uint64
#: Keys of the start and the end of a text.
START, END = _U(0x5A17E57A27), _U(0xE4D0F7E870)
_BLOCK = "block long, doc_ids array<long>, held_out array<boolean>, words binary, times binary, tokens binary, lengths array<int>"


def freeze(values: np.ndarray) -> bytes:
    """An integer array as compressed byte planes, which suits sorted keys and small counts."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def thaw(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def freeze_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as the gaps between them."""
    return freeze(np.diff(keys, prepend=_U(0)))


def thaw_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(thaw(blob, np.uint64), dtype=np.uint64)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def _block(number: int, rows: list[tuple]) -> pa.RecordBatch:
    ids, held, texts = zip(*rows, strict=True)
    hashes, first = word_hashes(list(texts))
    words, tokens, times = np.unique(np.concatenate([hashes, [END]]).astype(np.uint64), return_inverse=True, return_counts=True)
    rank = np.empty(len(words), dtype=np.uint32)
    rank[_by_frequency(times)] = np.arange(len(words), dtype=np.uint32)
    values = [number, list(ids), list(held), freeze_keys(words), freeze(times.astype(np.uint32)), freeze(rank[tokens[:-1]]), np.diff(first).tolist()]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[c.split()[0] for c in _BLOCK.split(", ")])


def _by_frequency(times: np.ndarray) -> np.ndarray:
    """Words by falling frequency; as numbers in this order, tokens take less room."""
    return np.argsort(-times.astype(np.int64), kind="stable")


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, rows, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for doc_id, held, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
            raw = text.encode().lower()  # bytes: A-Z only
            rows.append((doc_id, held, raw))
            size += len(raw) + 16
            if size >= BLOCK_BYTES:
                yield _block(number, rows)
                number, rows, size = number + 1, [], 0
    if rows:
        yield _block(number, rows)


class Block:
    """The token stream of a block: its words, its n-grams, and how often its texts for training hold them.

    grams: keys of all n-grams of two words or more, ascending, without their lowest `shift` bits. places: for each order
    from 1, the place in `words` or `grams` of the n-gram that ends with each token; contexts: for each order from 2, the
    place of its context there, where the start of a text comes behind all.
    """

    def __init__(self, row: dict, order: int = ORDER, shift: int = 0):
        self.words, lengths = thaw_keys(row["words"]), np.array(row["lengths"], dtype=np.int64)
        self.check = zlib.crc32(row["tokens"], zlib.crc32(row["words"]))
        self.n_tokens = lengths + 1
        self.start = np.cumsum(self.n_tokens) - self.n_tokens
        self.end_word, total = int(np.searchsorted(self.words, END)), int(self.n_tokens.sum())
        is_end = np.zeros(total, dtype=bool)
        is_end[np.cumsum(self.n_tokens) - 1] = True
        tokens = np.full(total, self.end_word, dtype=np.int64)
        tokens[~is_end] = _by_frequency(thaw(row["times"], np.uint32))[thaw(row["tokens"], np.uint32)]
        trains = np.repeat(~np.array(row["held_out"], dtype=bool), self.n_tokens)
        self.word_counts = np.bincount(tokens[trains], minlength=len(self.words)).astype(np.uint32)
        made, numbers, own = [], tokens, self.words
        for n in range(1, order):
            before = np.empty(total, dtype=np.int64)
            before[1:] = numbers[:-1]
            before[self.start] = len(own)
            grams, numbers = np.unique(before * len(self.words) + tokens, return_inverse=True)
            # the start has a key of its own for each order, or n-grams of different orders could share one
            own = mix(mix(np.append(own, START + _U(n))[grams // len(self.words)]) * _U(3) + self.words[grams % len(self.words)])
            made.append((numbers, own))
        none = np.empty(0, dtype=np.uint64)
        self.grams, where = np.unique(np.concatenate([none, *(keys >> _U(shift) for _, keys in made)]), return_inverse=True)
        self.gram_counts = np.zeros(len(self.grams), dtype=np.uint32)
        self.places, self.contexts, begin = [tokens], [], 0
        for numbers, keys in made:
            place = where[begin : begin + len(keys)][numbers]
            begin += len(keys)
            context = np.empty(total, dtype=np.int64)
            context[1:] = self.places[-1][:-1]
            context[self.start] = len(self.grams if self.contexts else self.words)
            self.gram_counts += np.bincount(place[trains], minlength=len(self.grams)).astype(np.uint32)
            self.places.append(place)
            self.contexts.append(context)


def _cuts(keys: np.ndarray, shards: int, shift: int = 0) -> np.ndarray:
    """Where each shard's range begins in ascending keys, and the end."""
    bounds = np.array([((k << 64) // shards) >> shift for k in range(shards)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, bounds), len(keys))


def _answer(requests: pa.Table) -> pa.Table:
    """Add up a shard's counts; answer each block in the order of its keys. The row of block -1 sums up the shard."""
    blocks, checks, totals = requests.column("block").to_pylist(), requests.column("check").to_pylist(), []
    answers: list[list[bytes]] = [[] for _ in blocks]
    for kind in ("word", "gram"):
        keys = [thaw_keys(b) for b in requests.column(f"{kind}_keys").to_pylist()]
        counts = [thaw(b, np.uint32) for b in requests.column(f"{kind}_counts").to_pylist()]
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(known))
        totals.append((int((total > 0).sum()), int(total.sum())))
        end = 0
        for k, own in enumerate(keys):
            wide = total.max(initial=0) >= 1 << 32
            part = total[at[end : end + len(own)]]
            answers[k].append(b"8" + freeze(part.astype(np.uint64)) if wide else b"4" + freeze(part.astype(np.uint32)))
            end += len(own)
    shard = requests.column("shard")[0].as_py()
    return pa.table(
        {
            "block": pa.array([*blocks, -1], pa.int64()), "shard": pa.array([shard] * (len(blocks) + 1), pa.int32()),
            "check": pa.array([*checks, 0], pa.int64()), "word_counts": pa.array([*(a[0] for a in answers), b""], pa.binary()),
            "gram_counts": pa.array([*(a[1] for a in answers), b""], pa.binary()),
            "distinct": pa.array([*[0] * len(blocks), totals[0][0]], pa.int64()), "total": pa.array([*[0] * len(blocks), totals[0][1]], pa.int64()),
        }
    )


_ANSWER = "block long, shard int, check long, word_counts binary, gram_counts binary, distinct long, total long"


class Automaton:
    """The part of the automaton that a block's texts can reach. Weights are log10; None: no such arc."""

    def __init__(self, block: Block, word_counts: np.ndarray, gram_counts: np.ndarray, total: int, distinct: int, weights: tuple[float, ...] = MU):
        shorter = (word_counts + 0.5) / (total + 0.5 * (distinct + 1))
        self.root = np.log10(shorter).tolist()
        # a context is left as often as it is read, but for the end; the start is left as often as the end is read
        left, starts = word_counts, word_counts[block.end_word]
        probability, self.failures = np.zeros(len(block.grams)), []
        for k, (place, context) in enumerate(zip(block.places[1:], block.contexts, strict=True)):
            mu = weights[min(k, len(weights) - 1)]
            leaving = np.append(left, starts) + mu
            own, at = np.unique(place, return_index=True)
            probability[own] = (gram_counts[own] + mu * shorter[block.places[k][at]]) / leaving[context[at]]
            self.failures.append(np.log10(mu / leaving).tolist())
            shorter, left = probability, gram_counts
        self.arcs = [w if seen else None for w, seen in zip(np.log10(probability).tolist(), (gram_counts > 0).tolist(), strict=True)]

    def traverse(self, tokens: list[int], steps: list[tuple[list[int], list[int]]]) -> float:
        """log10 probability of one text; steps: for each order from 2, where the arc of each token would be, and its state."""
        total, arcs = 0.0, self.arcs
        levels = [(failure, *step) for failure, step in zip(self.failures, steps, strict=True)][::-1]
        for i, token in enumerate(tokens):
            for failure, place, state in levels:
                weight = arcs[place[i]]
                if weight is not None:
                    total += weight
                    break
                total += failure[state[i]]
            else:
                total += self.root[token]
        return total


_SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the texts (and 16 for each), and how many tokens they have at most: one more than white space, and the end."""
    n_bytes = n_tokens = 0
    for batch in batches:
        texts = batch.column("text")
        raw, held = _bytes_of(texts), batch.num_rows
        n_bytes += len(raw) + 16 * held
        n_tokens += int(SPACE[raw].sum()) + 2 * held
    yield pa.RecordBatch.from_arrays([pa.array([n_bytes], pa.int64()), pa.array([n_tokens], pa.int64())], names=["bytes", "tokens"])


def _bytes_of(texts: pa.Array) -> np.ndarray:
    """The bytes of all texts of a column, one after the other."""
    binary = texts.cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)


def score_texts(docs: DataFrame, held: Column, order: int = ORDER, weights: tuple[float, ...] = MU) -> DataFrame:
    """Train on the rows where `held` is false, score all rows by n-grams of up to `order` words."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    blocks = rows.mapInArrow(_to_blocks, _BLOCK)
    told = rows.select("text").mapInArrow(_sizes, "bytes long, tokens long").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "tokens")]).first()
    bytes_, keys = told["bytes"], 1 + told["tokens"] * order  # there are no more n-grams than that
    shards, shift = max(min(SHARDS, 1 + bytes_ // BLOCK_BYTES), -(-keys // SHARD_KEYS)), max(0, 40 - keys.bit_length())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _to_blocks(batches):
            for row in batch.to_pylist():
                b = Block(row, order, shift)
                w, g = _cuts(b.words, shards), _cuts(b.grams, shards, shift)
                wanted = [k for k in range(shards) if w[k] < w[k + 1] or g[k] < g[k + 1]]
                parts = [[f(x[c[k] : c[k + 1]]) for k in wanted] for f, x, c in ((freeze_keys, b.words, w), (freeze, b.word_counts, w), (freeze_keys, b.grams, g), (freeze, b.gram_counts, g))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(wanted), pa.int64()), pa.array(wanted, pa.int32()), pa.array([b.check] * len(wanted), pa.int64()), *(pa.array(x, pa.binary()) for x in parts)],
                    names=["block", "shard", "check", "word_keys", "word_counts", "gram_keys", "gram_counts"],
                )

    requests = rows.mapInArrow(ask, "block long, shard int, check long, word_keys binary, word_counts binary, gram_keys binary, gram_counts binary")
    answers = materialize(requests.groupBy("shard").applyInArrow(_answer, _ANSWER), "count-answers")
    sums = answers.filter("block = -1").agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()
    distinct, total = sums["v"], sums["n"]

    def score(own: pa.Table, answered: pa.Table) -> pa.Table:
        (row,) = own.to_pylist()
        b = Block(row, order, shift)
        answered = answered.sort_by("shard")
        if set(answered.column("check").to_pylist()) != {b.check}:
            raise ValueError("the table gave other rows when it was read again; store it first")
        word_counts, gram_counts = (_joined(answered.column(c).to_pylist()) for c in ("word_counts", "gram_counts"))
        automaton = Automaton(b, word_counts, gram_counts, total, distinct, weights)
        tokens = b.places[0]
        base = np.log10((word_counts + 0.5) / (total + 0.5 * (distinct + 1)))[tokens]
        scores = []
        for s, n in zip(b.start.tolist(), b.n_tokens.tolist(), strict=True):
            steps = [(place[s : s + n].tolist(), context[s : s + n].tolist()) for place, context in zip(b.places[1:], b.contexts, strict=True)]
            scores.append(automaton.traverse(tokens[s : s + n].tolist(), steps))
        known = np.add.reduceat((word_counts > 0)[tokens].astype(np.int64), b.start)
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_()), "n_tokens": pa.array(b.n_tokens),
                "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(scores), total, dtype=np.int64)),
                "base_score": pa.array(np.add.reduceat(base, b.start)), "score": pa.array(scores, pa.float64()),
            }
        )

    asked = answers.filter("block >= 0").select("block", "shard", "check", "word_counts", "gram_counts")
    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(score, _SCORE)


def _joined(blobs: list[bytes]) -> np.ndarray:
    """Counts of a block from the shards' answers, whose first byte tells their width."""
    return np.concatenate([thaw(x[1:], np.uint64 if x[:1] == b"8" else np.uint32) for x in blobs]).astype(np.float64)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, held_out(F.col("doc_id")))
