"""Line de-duplication by a deletion-neighbourhood join.

Lines are equal if their lower-cased words are, however much white space is around them. Near lines are within one edit
(Levenshtein's) of each other, and one edit has to be a tenth of the line at most: lines of MIN_UNITS words or more are
compared word by word, others character by character, as code points, which also serves scripts that put no spaces
between words. Both lines have to be of the same kind and of MIN_UNITS units or more. With same_digits=True lines compared
by characters have to hold the same digits too; by default a number that differs by a digit is an edit like others. A
line goes if an equal line, or a near one, comes earlier; the earliest stays. Earlier means by doc_id (null first), then by a hash of the text, then by line number, over
the whole table. Lines of fewer than ten characters have no near lines, as an edit is too much of them; they go if an
equal line comes earlier. Blank lines always stay.

Each line has deletion variants: it without its unit i. Variants of a substitution are keyed by units, i and length, so
all lines with one key are within the bound of each other; a variant of an insertion is keyed as the shorter line, with
the shorter line itself. Hence the earliest line of each key is all that its other lines have to be compared with, and
groups need no pairs, however large. What is found is verified unit by unit. Lines within the bound share their first
or their last half; so only lines that share a half with another line emit variants, and only of the other half.

Nulls: a null text stays null and has no lines. Equal rows are one document: they get the same result. Empty lines and
texts stay, and long lines and texts are taken whole: a line emits as many variants as it has units, and only if it
shares a half with another line. An empty table gives an empty result. Extra columns are kept, but `removed` and `n_lines` are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, pack, row_numbers, table, unpack

MIN_UNITS = 10
#: Survivors of the first half are broadcast up to this many rows (about 50 bytes each), else joined by a shuffle.
BROADCAST_ROWS = 300_000
_MASK = (1 << 40) - 1


_BLANKS = " \t\r\x0b\x0c"


def line_key(line: Column) -> Column:
    """What makes lines equal: their lower-cased text without blanks at either end, one blank for any white space inside."""
    # most lines hold single blanks only, and need neither the pattern nor a trim of many characters
    odd = reduce(or_, [F.contains(line, F.lit(b)) for b in ("  ", *_BLANKS[1:])])
    even_out = F.regexp_replace(F.lower(F.trim(line, F.lit(_BLANKS))), r"[\t\r\x0b\x0c][ \t\r\x0b\x0c]*| [ \t\r\x0b\x0c]+", " ")
    return F.when(odd, even_out).otherwise(F.lower(F.trim(line)))


def n_words(key: Column) -> Column:
    return F.octet_length(key) - F.octet_length(F.replace(key, F.lit(" "), F.lit(""))) + 1


def line_words(key: Column) -> Column:
    return F.split(key, " ")


def line_units(key: Column) -> Column:
    """The words of a line of MIN_UNITS words or more, else its characters."""
    words = line_words(key)
    return F.when(F.size(words) >= MIN_UNITS, words).otherwise(F.regexp_extract_all(key, F.lit("(?s)."), F.lit(0)))


def line_kind(key: Column, words: Column, same_digits: bool = False) -> Column:
    """What near lines have in common: 0 for lines of words, 1 or a hash of the digits for lines of characters."""
    return F.when(F.size(words) >= MIN_UNITS, F.lit(0).cast("long")).otherwise(_of_characters(key, same_digits))


def _of_characters(key: Column, same_digits: bool) -> Column:
    return F.xxhash64(F.regexp_replace(key, "[^0-9]", "")) if same_digits else F.lit(1).cast("long")


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie, line_no, key, k1, k2 (128-bit hash of the key), without blank lines."""
    each = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # explode() makes the key a column that is worked out once
    rows = each.select("doc_id", "tie", "line_no", F.explode(F.array(line_key(F.col("line")))).alias("key")).filter("key <> ''")
    return rows.withColumns({"k1": F.xxhash64("key"), "k2": F.xxhash64(F.lit(7), "key")})


def _halves(kind: Column, n: Column, first, last) -> Column:
    """The keys of both halves, for partners of the same length or shorter (length n) and for longer ones (n + 1).

    For lengths m and m - 1 the first m div 2 units, or else the last m - m div 2, are equal. first(k) and last(k) give
    the first and the last k units.
    """
    out = []
    for shift in (0, 1):
        m = n + shift
        f = F.floor(m / 2).cast("int")
        back = m - f
        for side, half in ((0, first(f)), (1, last(back))):
            out.append(F.struct(F.lit(shift).alias("shift"), F.lit(side).alias("side"), F.xxhash64(kind, m, F.lit(side), half).alias("half")))
    return F.array(*out)


def _at(c: Column, position: Column, seed: int) -> Column:
    return F.xxhash64(c, position, F.lit(seed)).bitwiseAND(F.lit(_MASK))


def _open_lines(distinct: DataFrame) -> DataFrame:
    """Lines that share a half with another one, and which variants they have to emit: k1, k2, first, kinds."""
    halves = distinct.filter("halves IS NOT NULL").select("k1", "k2", "first", F.explode("halves").alias("h")).select("k1", "k2", "first", "h.*")
    counted = halves.groupBy("half").agg(F.count_if(F.col("shift") == 0).alias("same"), F.count_if(F.col("shift") == 1).alias("shorter"))
    counted = counted.filter("same > 1 OR (same > 0 AND shorter > 0)")
    # side 0: the first half is shared, so the edit is in the second
    kind = F.when(F.col("shift") == 1, F.array(F.lit("full"))).otherwise(
        F.filter(
            F.array(
                F.when(F.col("same") > 1, F.when(F.col("side") == 0, "sub_right").otherwise("sub_left")),
                F.when(F.col("shorter") > 0, F.when(F.col("side") == 0, "del_right").otherwise("del_left")),
            ),
            lambda x: x.isNotNull(),
        )
    )
    shared = halves.join(counted, "half").filter("shift = 0 OR same > 0").select("k1", "k2", "first", kind.alias("kinds"))
    return shared.groupBy("k1", "k2").agg(F.first("first").alias("first"), F.array_distinct(F.flatten(F.collect_list("kinds"))).alias("kinds"))


def _variants(open_lines: DataFrame) -> DataFrame:
    """v1, v2 (key of a variant), role, o (number of the line)."""
    n, words = F.size("words"), F.col("words")
    kind = F.col("kind")

    def sums(seed: int) -> Column:
        return F.transform(words, lambda w, j: _at(w, j, seed))

    base = open_lines.withColumns({"n": n, "f": F.floor(n / 2).cast("int"), "h1": sums(1), "h2": sums(2)})
    zero = F.lit(0).cast("long")
    base = base.withColumns({f"t{s}": F.aggregate(f"h{s}", zero, lambda a, x: a + x) for s in (1, 2)})
    places = F.concat(
        F.when(F.array_contains("kinds", "sub_left"), F.sequence(F.lit(0), F.col("f") - 1)).otherwise(F.array().cast("array<int>")),
        F.when(F.array_contains("kinds", "sub_right"), F.sequence(F.col("f"), F.col("n") - 1)).otherwise(F.array().cast("array<int>")),
    )
    sub = base.select("o", "kind", "n", "h1", "h2", "t1", "t2", F.explode(places).alias("i")).select(
        F.xxhash64(F.lit(0), kind, "n", "i", F.col("t1") - F.get("h1", F.col("i"))).alias("v1"),
        F.xxhash64(F.lit(1), kind, "n", "i", F.col("t2") - F.get("h2", F.col("i"))).alias("v2"),
        F.lit("sub").alias("role"),
        "o",
    )
    key = [F.xxhash64(F.lit(2), kind, "m", "d1").alias("v1"), F.xxhash64(F.lit(3), kind, "m", "d2").alias("v2")]
    full = base.filter(F.array_contains("kinds", "full")).select("kind", F.col("n").alias("m"), F.col("t1").alias("d1"), F.col("t2").alias("d2"), "o")
    full = full.select(*key, F.lit("full").alias("role"), "o")
    # units behind the deleted one move up by one place: a running sum of those before it, and what is left of the moved ones' total
    gone = open_lines.filter(F.array_contains("kinds", "del_left") | F.array_contains("kinds", "del_right"))

    def moved(seed: int) -> Column:
        return F.aggregate(F.transform(words, lambda w, j: _at(w, j - 1, seed)), zero, lambda a, x: a + x)

    each = gone.withColumns({"m1": moved(1), "m2": moved(2)}).select("o", "kind", "kinds", F.size("words").alias("n"), "m1", "m2", F.posexplode("words").alias("i", "w"))
    upto = W.partitionBy("o").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    here = {s: (_at(F.col("w"), F.col("i"), s), _at(F.col("w"), F.col("i") - 1, s)) for s in (1, 2)}
    # the sum of (as it is, less moved) up to here, less the deleted unit itself
    d = {f"d{s}": F.sum(own - up).over(upto) - own + F.col(f"m{s}") for s, (own, up) in here.items()}
    left = F.col("i") < F.floor(F.col("n") / 2)
    short = each.withColumns(d).filter((left & F.array_contains("kinds", "del_left")) | (~left & F.array_contains("kinds", "del_right")))
    short = short.withColumn("m", F.col("n") - 1).select(*key, F.lit("var").alias("role"), "o")
    return sub.unionByName(full).unionByName(short)


def within_one(a: Column, b: Column) -> Column:
    """Whether two arrays of units differ by one substitution, insertion or deletion at most."""

    def longer(x: Column, y: Column) -> Column:
        apart = F.transform(F.sequence(F.lit(1), F.size(x)), lambda i: (i > F.size(y)) | (F.try_element_at(x, i) != F.try_element_at(y, i)))
        at = F.array_position(apart, True)
        return F.slice(x, at.cast("int") + 1, F.size(x)) == F.slice(y, at.cast("int"), F.size(x))

    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d)) <= 1
    return (
        F.when(F.size(a) == F.size(b), same)
        .when(F.size(a) == F.size(b) + 1, longer(a, b))
        .when(F.size(b) == F.size(a) + 1, longer(b, a))
        .otherwise(False)
    )


def _later_neighbours(docs: DataFrame, distinct: DataFrame, same_digits: bool) -> DataFrame:
    """Keys (k1, k2) of lines that are within the bound of an earlier line.

    Open lines are numbered in their order first, so that variants carry and compare a number each.
    """
    open_lines = _open_lines(distinct).select("k1", "k2", "first.*", "kinds")
    found, n = row_numbers(open_lines, ["doc_id", "tie", "line_no", "k1", "k2"], "o", "open-lines")
    by_doc = found.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("line_no", "o", "kinds")).alias("here"))
    if n <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    by_doc = by_doc.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "here")
    texts = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    joined = texts.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")))
    split = joined.withColumn("lines", F.split("text", "\n")).select("lines", F.explode("here").alias("x"))
    # explode() makes the key a column that is worked out once
    keyed = split.select("x.o", "x.kinds", F.explode(F.array(line_key(F.get("lines", F.col("x.line_no"))))).alias("key"))
    own = keyed.select("o", "kinds", line_kind(F.col("key"), line_words(F.col("key")), same_digits).alias("kind"), line_units(F.col("key")).alias("words")).dropDuplicates(["o"])
    own = materialize(own, "open-words")
    variants = _variants(own)
    earliest = variants.groupBy("v1", "v2").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("role") == "sub", F.col("o"))).alias("sub"),
        F.min(F.when(F.col("role") == "full", F.col("o"))).alias("full"),
        F.min(F.when(F.col("role") == "var", F.col("o"))).alias("var"),
    )
    earliest = earliest.filter("n > 1 AND (sub IS NOT NULL OR (full IS NOT NULL AND var IS NOT NULL))").drop("n")
    other = F.when(F.col("role") == "sub", F.col("sub")).when(F.col("role") == "full", F.col("var")).otherwise(F.col("full"))
    pairs = variants.join(earliest, ["v1", "v2"]).select("o", other.alias("e")).filter("e < o").distinct()
    words = own.select("o", F.col("words").alias("a"))
    both = pairs.join(words, "o").join(words.select(F.col("o").alias("e"), F.col("a").alias("b")), "e")
    near = both.filter(within_one(F.col("a"), F.col("b"))).select("o").distinct()
    return near.join(found.select("o", "k1", "k2"), "o").select("k1", "k2")


def removals(docs: DataFrame, same_digits: bool = False) -> DataFrame:
    """doc_id, tie and the numbers (from 0) of the lines that go."""
    each = lines(docs)
    key, n = F.col("key"), F.col("n_words")
    worded = each.withColumn("n_words", F.explode(F.array(n_words(key))))
    of_words = n >= MIN_UNITS

    def some_words(k: Column) -> Column:
        return F.call_function("substring_index", key, F.lit(" "), k)

    halves = F.when(of_words, _halves(F.lit(0).cast("long"), n, some_words, lambda k: some_words(-k)))
    # lines of characters keep their text until they are distinct
    unspaced = F.when(~of_words & (F.length(key) >= MIN_UNITS), key)
    place = F.struct("doc_id", "tie", "line_no")
    distinct = worded.select("k1", "k2", place.alias("place"), halves.alias("halves"), unspaced.alias("key")).groupBy("k1", "k2").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves"), F.first("key").alias("key")
    )
    size = F.length(key)
    by_character = F.when(key.isNotNull(), _halves(_of_characters(key, same_digits), size, lambda k: F.substring(key, 1, k), lambda k: F.substring(key, size - k + 1, k)))
    distinct = materialize(distinct.select("k1", "k2", "first", "n", F.coalesce("halves", by_character).alias("halves")), "distinct-lines")
    near = materialize(_later_neighbours(docs, distinct, same_digits).withColumn("near", F.lit(True)), "near-lines")
    marks = distinct.select("k1", "k2", "first", "n").join(near, ["k1", "k2"], "left").filter("n > 1 OR near").select("k1", "k2", "first", "near")
    gone = each.select("k1", "k2", "doc_id", "tie", "line_no", place.alias("place")).join(marks, ["k1", "k2"])
    gone = gone.filter(F.col("near").isNotNull() | (F.col("place") != F.col("first")))
    return gone.groupBy("doc_id", "tie").agg(F.collect_set("line_no").alias("gone"))


def dedup_lines(docs: DataFrame, same_digits: bool = False) -> DataFrame:
    """docs with the text rid of repeated lines, n_lines (before) and removed (their number)."""
    gone = removals(docs.select("doc_id", "text"), same_digits).select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "gone")
    packed = pack(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text"))
    joined = packed.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    kept = F.transform(F.filter(numbered, lambda x: ~F.array_contains("gone", x["i"])), lambda x: x["line"])
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    split = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    return unpack(joined, docs, text=text, n_lines=split.cast("long"), removed=F.coalesce(F.size("gone"), F.lit(0)).cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "removed", F.length(kept).cast("long").alias("kept_chars"), F.sha2(kept, 256).alias("kept_sha256"))


ORACLE = f"""
WITH each AS (
  SELECT doc_id, i - 1 AS line_no, line,
    regexp_replace(lower(trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))), '[\\t\\r\\x0b\\x0c][ \\t\\r\\x0b\\x0c]*| [ \\t\\r\\x0b\\x0c]+', ' ', 'g') AS k
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
), firsts AS (
  SELECT k, string_split(k, ' ') AS ws, min((doc_id, line_no)) AS p FROM each WHERE k <> '' GROUP BY k
), units AS (
  SELECT k, p, '' AS kind, ws FROM firsts WHERE len(ws) >= {MIN_UNITS}
  UNION ALL SELECT k, p, 'c', regexp_extract_all(k, '(?s).') FROM firsts WHERE len(ws) < {MIN_UNITS} AND length(k) >= {MIN_UNITS}
), longish AS (
  SELECT row_number() OVER () AS r, k, kind, ws, p, len(ws) AS n FROM units
), halves AS (
  SELECT r, kind, m, 0 AS side, list_slice(ws, 1, m // 2) AS h FROM (SELECT *, unnest([n, n + 1]) AS m FROM longish)
  UNION ALL SELECT r, kind, m, 1, list_slice(ws, n - (m - m // 2) + 1, n) FROM (SELECT *, unnest([n, n + 1]) AS m FROM longish)
), pairs AS (
  SELECT DISTINCT a.r AS x, b.r AS y FROM halves a JOIN halves b ON a.kind = b.kind AND a.m = b.m AND a.side = b.side AND a.h = b.h AND a.r <> b.r
), near AS (
  SELECT DISTINCT x.k FROM pairs JOIN longish x ON x.r = pairs.x JOIN longish y ON y.r = pairs.y
  WHERE y.p < x.p AND CASE
    WHEN x.n = y.n THEN len(list_filter(range(1, x.n + 1), lambda i: x.ws[i] <> y.ws[i])) <= 1
    WHEN x.n = y.n + 1 THEN len(list_filter(range(1, x.n + 1), lambda i: list_slice(x.ws, 1, i - 1) = list_slice(y.ws, 1, i - 1) AND list_slice(x.ws, i + 1, x.n) = list_slice(y.ws, i, y.n))) > 0
    WHEN y.n = x.n + 1 THEN len(list_filter(range(1, y.n + 1), lambda i: list_slice(y.ws, 1, i - 1) = list_slice(x.ws, 1, i - 1) AND list_slice(y.ws, i + 1, y.n) = list_slice(x.ws, i, x.n))) > 0
    ELSE FALSE END
), judged AS (
  SELECT doc_id, line_no, line, each.k <> '' AND (near.k IS NOT NULL OR (doc_id, line_no) <> p) AS gone
  FROM each LEFT JOIN firsts ON firsts.k = each.k LEFT JOIN near ON near.k = each.k
), texts AS (
  SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS removed, coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY line_no), '') AS kept
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(removed, 0)::BIGINT AS removed, length(coalesce(kept, ''))::BIGINT AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN texts USING (doc_id)
"""
