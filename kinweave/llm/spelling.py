"""Spelling variants by a bit-sliced position index.

Words are runs of LETTERS with A-Z lowered. The vocabulary (words of some length that occur often enough) is cut into groups
of words that can be one letter apart; for each group there is a bitset over its words for every (position, letter). A word
of m letters is looked up letter by letter: word-parallel recurrences keep the set of group words without an error so far
and, at the same places or shifted by one position, the sets of those with one error:

    none' = none & at[k, letter]
    replaced' = replaced & at[k, letter]  |  none & ~at[k, letter]
    longer' = longer & at[k + 1, letter]  |  none'            (one letter more in the group's word)

What is left at the end are the words that differ by exactly one replaced or inserted letter; a deletion is an insertion
seen from the other word. Words are sorted by how often they occur, so the first bit of a set is the most frequent one.

Groups: one error leaves the first or the second half of the shorter word whole, so a word is put under its length, which
half it is, and a bucket of that half's hash; buckets grow in number with the vocabulary. Results of first halves need an
equal first half, those of second halves an unequal one, so no pair is found twice. A group of more than GROUP_LETTERS is
split into blocks of words, and each pair of its blocks is a group of its own, so that no task holds a whole hot group.

`form` of a word is its near word of largest n (then least in code-point order) if that n is `ratio` times the word's at
least; `root` is where the forms lead. As n grows along every step, chains end, after log2(n) steps at most.

Nulls: a null text has no words; a null doc_id counts as an empty string where it is hashed. Empty texts have no words; long
ones are read in parts. Repeated rows count each. An empty table gives an empty result. Columns beside doc_id and text are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small, table
from .sqlparts import CRC_TABLE, crc32

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
#: One run of DAMAGED loses a letter (the query's planted misspellings).
DAMAGED = 97
#: Words counted in a task before they are handed on; letters of a group at most; words a bucket is meant for.
HELD, GROUP_LETTERS, BUCKET = 1 << 18, 1 << 17, 1 << 14
#: Characters of a text that are split at once.
PART = 1 << 20
_RUN, _BETWEEN = re.compile("[a-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")


def _runs(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of a text, part by part; parts end between runs."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PART) if len(text) - at > PART else None
        end = cut.start() if cut else len(text)
        yield _RUN.findall(text[at:end].encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        at = end


def _counter(min_length: int, damaged: int):
    """A function for mapInArrow: doc_id, text to word, n, counted inside the task."""

    def emit(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                begun = zlib.crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
                for runs in _runs(text.as_py()):
                    for run, n in Counter(runs).items():
                        if len(run) < min_length:
                            continue
                        if damaged:
                            h = zlib.crc32(run.encode(), begun)
                            if h % damaged == 0:
                                k = h % len(run)
                                run = run[:k] + run[k + 1 :]
                                if len(run) < min_length:
                                    continue
                        counts[run] = counts.get(run, 0) + n
                    if len(counts) >= HELD:
                        yield emit(counts)
                        counts = {}
        if counts:
            yield emit(counts)

    return count


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damaged: int = 0) -> DataFrame:
    """word, n: all words of min_length letters that occur min_count times, stored. damaged: see DAMAGED; 0 damages none."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_counter(min_length, damaged), "word string, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "vocabulary")


def _codes(words: list[str], width: int) -> np.ndarray:
    """Letters of the words by position, as small numbers; 0 where a word has ended."""
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), dtype="<u4").reshape(len(words), width)
    return np.unique(flat, return_inverse=True)[1].reshape(flat.shape).astype(np.int64) if len(words) else np.zeros((0, width), np.int64)


def _bitsets(column: np.ndarray, n_letters: int, n_words: int) -> np.ndarray:
    """For one position: a row of bits over the words for every letter."""
    bits = np.zeros((n_letters, 64 * n_words), dtype=np.uint8)
    bits[column, np.arange(len(column))] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of every bit set, by row and then by bit."""
    row, word = np.nonzero(sets)
    which, bit = np.nonzero((sets[row, word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    return row[which], word[which] * 64 + bit


def near(asked: list[str], words: list[str], m: int, first_half: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in asked, place in words) of words exactly one letter apart, by asked and then by words.

    asked: words of m letters; words: of m or m + 1 letters. Only pairs whose first m // 2 letters are equal, or unequal.
    """
    none_found = np.zeros(0, np.int64)
    if not asked or not words:
        return none_found, none_found
    codes = _codes([*asked, *words], m + 1)
    asks, codes = codes[: len(asked)], codes[len(asked) :]
    n_letters, n_words = int(max(asks.max(), codes.max())) + 1, -(-len(words) // 64)
    lengths = np.array([len(w) for w in words])
    everything = _bitsets(np.zeros(len(words), np.int64), 1, n_words)[0]
    same_length, longer_length = (_bitsets((lengths == x).astype(np.int64), 2, n_words)[1] for x in (m, m + 1))
    none = np.broadcast_to(everything, (len(asked), n_words)).copy()
    replaced, longer, halves = np.zeros_like(none), none.copy(), none
    here = _bitsets(codes[:, 0], n_letters, n_words)
    for k in range(m):
        following = _bitsets(codes[:, k + 1], n_letters, n_words)
        at = here[asks[:, k]]
        replaced &= at
        replaced |= none & ~at
        none = none & at
        longer &= following[asks[:, k]]
        longer |= none
        if k + 1 == m // 2:
            halves = none
        here = following
    found = (replaced & same_length) | (longer & longer_length)
    return _members(found & (halves if first_half else ~halves))


NEAR = "word string, n_near long, best_n long, best string"


def _summed(own: np.ndarray, other: np.ndarray, own_words: list[str], other_words: list[str], other_n: np.ndarray) -> list:
    """For each word of `own` the number of its pairs and its best partner, which is its first; pairs come sorted by own."""
    which, first, n = np.unique(own, return_index=True, return_counts=True)
    best = other[first]
    return [pa.array([own_words[k] for k in which], pa.string()), pa.array(n), pa.array(other_n[best]), pa.array([other_words[k] for k in best], pa.string())]


def _look_up(group: pa.Table) -> pa.Table:
    """One group: its words of m letters against all its words; a row for each word with a near one."""
    m, first_half = group.column("m")[0].as_py(), group.column("side")[0].as_py() == 0
    rows = list(zip(*(group.column(c).to_pylist() for c in ("n", "word", "asks", "answers")), strict=True))
    rows.sort(key=lambda r: (-r[0], r[1]))
    asked, words = [r for r in rows if r[2]], [r for r in rows if r[3]]
    own, other = near([r[1] for r in asked], [r[1] for r in words], m, first_half)
    own_words, other_words = [r[1] for r in asked], [r[1] for r in words]
    own_n, other_n = np.array([r[0] for r in asked], np.int64), np.array([r[0] for r in words], np.int64)
    parts = [_summed(own, other, own_words, other_words, other_n)]
    # a pair of unequal lengths is met from its shorter word alone
    back = np.flatnonzero(np.array([len(w) for w in other_words], np.int64)[other] > m) if len(other) else other
    back = back[np.argsort(other[back], kind="stable")]
    parts.append(_summed(other[back], own[back], other_words, own_words, own_n))
    names = [c.split()[0] for c in NEAR.split(", ")]
    return pa.concat_tables([pa.Table.from_arrays(p, names=names) for p in parts])


def groups(words: DataFrame, n_words: int, min_length: int = MIN_LENGTH, bucket: int = BUCKET, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """Rows m, side, bucket, asking, answering (blocks), word, n, asks, answers: all that has to be looked up together.

    A word of m letters asks and answers in the groups of its own halves, and answers, being one letter longer, in those
    of the words of m - 1 letters.
    """
    length = F.length("word")
    own = [F.struct(length.alias("m"), F.lit(s).alias("side"), h.alias("half"), F.lit(True).alias("asks")) for s, h in enumerate((
        F.substring("word", F.lit(1), F.floor(length / 2).cast("int")), F.substring("word", F.floor(length / 2).cast("int") + 1, length)
    ))]
    m = length - 1
    kept = m - F.floor(m / 2).cast("int")
    longer = [F.struct(m.alias("m"), F.lit(s).alias("side"), h.alias("half"), F.lit(False).alias("asks")) for s, h in enumerate((
        F.substring("word", F.lit(1), F.floor(m / 2).cast("int")), F.substring("word", length - kept + 1, kept)
    ))]
    each = F.when(m >= min_length, F.array(*own, *longer)).otherwise(F.array(*own))
    placed = words.withColumn("as", F.explode(each)).select("word", "n", "as.m", "as.side", "as.asks", F.pmod(F.xxhash64("as.half"), F.lit(max(1, -(-n_words // bucket)))).alias("bucket"))
    key = ["m", "side", "bucket"]
    # of groups that are too large there are fewer than letters of the vocabulary / group_letters
    letters = placed.groupBy(*key).agg(F.sum(F.length("word")).alias("letters")).filter(F.col("letters") > group_letters)
    split = placed.join(small(letters), key, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("letters") / group_letters), F.lit(1)).cast("int"))
    mine, all_blocks = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    asking = F.transform(all_blocks, lambda b: F.struct(mine.alias("asking"), b.alias("answering"), F.lit(True).alias("asks"), (b == mine).alias("answers")))
    answering = F.transform(all_blocks, lambda b: F.struct(b.alias("asking"), mine.alias("answering"), F.lit(False).alias("asks"), F.lit(True).alias("answers")))
    # where a word asks and answers in the same pair of blocks, one row does both
    both = F.concat(asking, F.filter(answering, lambda x: x["asking"] != x["answering"]))
    spread = split.withColumn("to", F.explode(F.when(F.col("asks"), both).otherwise(answering)))
    return spread.select(*key, "to.asking", "to.answering", "word", "n", "to.asks", "to.answers")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, bucket: int = BUCKET, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """For each word with a near one: word, n_near, best_n, best (most frequent, then least). `words`: word (a key), n."""
    dealt = groups(words, words.count(), min_length, bucket, group_letters)
    found = dealt.groupBy("m", "side", "bucket", "asking", "answering").applyInArrow(_look_up, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return summed.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def variants(words: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH, bucket: int = BUCKET, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary (word, n)."""
    joined = words.join(near_words(words, min_length, bucket, group_letters), "word", "left")
    has = F.col("best_n") >= ratio * F.col("n")
    told = materialize(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
        "word-forms",
    )
    # pointer jumping: after each round every pointer leads twice as far
    to = told.filter("form IS NOT NULL").select("word", F.col("form").alias("at"))
    while True:
        onward = to.select(F.col("word").alias("at"), F.col("at").alias("onward"))
        jumped = materialize(to.join(onward, "at", "left").select("word", F.coalesce("onward", "at").alias("at"), F.col("onward").isNotNull().alias("moved")), "word-roots")
        if jumped.filter("moved").isEmpty():
            break
        to = jumped.select("word", "at")
    return told.join(to, "word", "left").select("word", "form", F.coalesce("at", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents"), damaged=DAMAGED))


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_LENGTH} GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_tab
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), pairs AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT a.rest, a.word, a.n FROM less a JOIN vocabulary b ON a.rest = b.word
    UNION ALL SELECT a.word, b.word, b.n FROM less a JOIN vocabulary b ON a.rest = b.word)
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM pairs GROUP BY word
), told AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= {RATIO} * n THEN other END AS form, CASE WHEN other_n >= {RATIO} * n THEN other_n END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM told
  UNION ALL SELECT chain.word, told.form FROM chain JOIN told ON told.word = chain.at WHERE told.form IS NOT NULL
)
SELECT told.word, told.form, chain.at AS root, told.n, told.n_near, told.form_n::BIGINT AS form_n
FROM told JOIN chain USING (word) JOIN told ends ON ends.word = chain.at WHERE ends.form IS NULL
"""
