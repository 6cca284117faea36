"""Language identification as inference of a multilingual mixture.

A document is taken as a mixture of languages: each of its character trigrams is drawn from one of them. Training
counts hashed trigrams of every labelled training text, in full, by language. For a document, expectation-maximisation
estimates the proportions of the languages from the trigrams' likelihoods; the set of languages is chosen by penalised
likelihood (BIC): starting from the best single language, the language that helps most is added as long as the
likelihood gains more than its penalty. The prediction is the language of the largest share, the score that share times
the posterior weight of the leading language alone against its nearest rival, so that it lies in 0 to 1.

The model has BUCKETS x languages probabilities whatever the corpus size; its table is shared with the tasks only after
the number of languages has been checked against `most` of train() (400 languages are 105 MB); more are refused.

Nulls: a null text, and one without any letter, is `und` with score 0 and takes no part in training, nor does a null
language. Ties go to the alphabetically first language. Without training documents all is `und`. Very long texts are
taken whole, in parts cut between words, which changes no trigram; counts weigh by occurrence. Extra columns are kept by identify() except those it adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pack, table, unpack
from .shingles import mix

BUCKETS = 1 << 15
MOST_LANGUAGES = 400
#: EM rounds, and the part of a trigram's probability that is spread evenly over all buckets.
ROUNDS, SMOOTHING = 12, 0.5
#: Texts are worked on in blocks of about this many characters.
BLOCK = 1 << 20
_U = np.uint64


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_TABLE: list[np.ndarray] = []


_PARTS = re.compile(r"\s")


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, bucket and count of the distinct trigram buckets of each text; ascending in both.

    Texts are runs of letters; what lies between two runs counts as one blank, as do both ends. So a long text can be cut
    at any white space.
    """
    if len(texts) != 1 or len(texts[0]) <= 2 * BLOCK:
        return _trigrams(texts)
    (text,), total, at = texts, np.zeros(BUCKETS, dtype=np.int64), 0
    while at < len(text):
        cut = _PARTS.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        _, bucket, counts = _trigrams([text[at:end]])
        total[bucket] += counts
        at = end
    bucket = np.flatnonzero(total)
    return np.zeros(len(bucket), dtype=np.int64), bucket, total[bucket]


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not _TABLE:
        _TABLE.append(_letters())
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _TABLE[0][codes]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(ends, prepend=0))
    keep = low > 0
    keep[1:] |= low[:-1] > 0  # the first blank behind a run stays
    low, doc = low[keep], doc[keep]
    if len(low) < 2:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    # the blank that closes the word before opens a word; a text's first word has none of its own text, so one is put in
    first = np.ones(len(doc), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    at = np.flatnonzero(first)
    low, doc = np.insert(low, at, 0), np.insert(doc, at, doc[at])
    a, b, c = low[:-2].astype(np.uint64), low[1:-1].astype(np.uint64), low[2:].astype(np.uint64)
    inside = (doc[:-2] == doc[2:]) & (b > 0)
    key = mix((a << _U(42)) | (b << _U(21)) | c)
    where = doc[:-2][inside].astype(np.int64) * BUCKETS + (key[inside] >> _U(49)).astype(np.int64)
    found, counts = np.unique(where, return_counts=True)
    return found // BUCKETS, found % BUCKETS, counts


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    begin, block, held = 0, [], 0
    for k, text in enumerate(texts):
        block.append(text or "")
        held += len(text or "")
        if held >= BLOCK:
            yield begin, block
            begin, block, held = k + 1, [], 0
    if block:
        yield begin, block


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: language, bucket, count."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, block in _blocks(batch.column("text").to_pylist()):
            doc, bucket, count = trigrams(block)
            names = np.array(langs[begin : begin + len(block)], dtype=object)
            for lang in sorted(set(names)):
                own = (names == lang)[doc]
                total = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                total += np.bincount(bucket[own], weights=count[own], minlength=BUCKETS).astype(np.int64)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])], names=["lang", "bucket", "n"])


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    #: BUCKETS x languages: probability of a trigram bucket in a language.
    probabilities: np.ndarray


def train(docs: DataFrame, most: int = MOST_LANGUAGES) -> LanguageModel:
    """Count the trigrams of all rows with a text and a language; ValueError if there are more than `most` languages."""
    labelled = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = labelled.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    langs = sorted(r["lang"] for r in labelled.select("lang").distinct().limit(most + 1).collect())
    if len(langs) > most:
        raise ValueError(f"more than {most} languages")
    rows = counts.toArrow()
    n = np.zeros((BUCKETS, len(langs)))
    if rows.num_rows:
        column = {lang: k for k, lang in enumerate(langs)}
        at = np.array([column[x] for x in rows.column("lang").to_pylist()])
        n[rows.column("bucket").to_numpy(), at] = rows.column("n").to_numpy()
    return LanguageModel(langs, (n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * BUCKETS))


def infer(texts: list[str], model: LanguageModel) -> list[tuple[str, float, dict[str, float]]]:
    """Prediction, score and shares by language of each text."""
    out = [("und", 0.0, {})] * len(texts)
    doc, bucket, counts = trigrams(texts)
    if not len(doc) or not model.languages:
        return out
    ids, starts = np.unique(doc, return_index=True)
    at, counts = np.searchsorted(ids, doc), counts.astype(np.float64)
    p, n = model.probabilities[bucket], np.add.reduceat(counts, starts)
    single = np.add.reduceat(counts[:, None] * np.log(p), starts, axis=0)
    k = len(model.languages)
    best = single.argmax(axis=1)
    # posterior of the best against the others, each taken alone, by trigram, as they aren't independent
    odds = np.exp((single - single.max(axis=1, keepdims=True)) / np.sqrt(n)[:, None])
    chosen = np.zeros((len(ids), k), dtype=bool)
    chosen[np.arange(len(ids)), best] = True
    share = chosen.astype(np.float64)
    reached, open_ = single.max(axis=1), np.ones(len(ids), dtype=bool)
    penalty = 0.5 * np.log(n) + np.log(k)
    while k > 1 and open_.any() and not chosen[open_].all():
        gain = np.full((len(ids), k), -np.inf)
        shares: dict[int, np.ndarray] = {}
        for extra in range(k):
            try_ = open_ & ~chosen[:, extra]
            if not try_.any():
                continue
            sets = chosen.copy()
            sets[:, extra] = True
            rows = try_[at]
            sub = np.flatnonzero(try_)
            s = np.searchsorted(sub, at[rows])
            first = np.searchsorted(s, np.arange(len(sub)))
            masked = p[rows] * sets[at[rows]]
            # languages outside the set have no share
            width = sets[sub].any(axis=0)
            q = masked[:, width]
            start_share = sets[sub][:, width] / sets[sub].sum(axis=1, keepdims=True)
            got, like = _em(q, s, first, counts[rows], n[sub], start_share)
            gain[sub, extra] = like - reached[sub]
            full = np.zeros((len(ids), k))
            full[np.ix_(sub, np.flatnonzero(width))] = got
            shares[extra] = full
        top = gain.argmax(axis=1)
        better = open_ & (gain[np.arange(len(ids)), top] > penalty)
        for d in np.flatnonzero(better):
            chosen[d, top[d]] = True
            share[d] = shares[top[d]][d]
            reached[d] += gain[d, top[d]]
        open_ = better
    lead = share.argmax(axis=1)
    score = share.max(axis=1) * odds[np.arange(len(ids)), lead] / odds.sum(axis=1)
    for row, d in enumerate(ids):
        names = {model.languages[j]: float(share[row, j]) for j in np.flatnonzero(share[row] > 0)}
        out[d] = (model.languages[lead[row]], float(min(1.0, score[row])), names)
    return out


def _em(q, doc, starts, counts, n, share) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each document and its log-likelihood, by EM from `share`; q: likelihoods, trigrams x languages."""
    for _ in range(ROUNDS):
        weighted = q * share[doc]
        weighted *= (counts / weighted.sum(axis=1))[:, None]
        share = np.add.reduceat(weighted, starts, axis=0) / n[:, None]
    return share, np.add.reduceat(counts * np.log((q * share[doc]).sum(axis=1)), starts)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred, score and lang_shares (a map)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, lang_shares map<string,double>")
    def infer_udf(text):
        import pandas as pd

        rows = [r for _, block in _blocks(list(text)) for r in infer(block, shared.value)]
        return pd.DataFrame({"lang_pred": [r[0] for r in rows], "score": [r[1] for r in rows], "lang_shares": [r[2] for r in rows]})

    named = pack(docs, "text").withColumn("_found", infer_udf("text"))
    return unpack(named, docs, lang_pred=F.col("_found.lang_pred"), score=F.col("_found.score"), lang_shares=F.col("_found.lang_shares"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.filter("NOT held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "lang_shares")
