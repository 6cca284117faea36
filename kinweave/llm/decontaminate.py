"""Benchmark decontamination by a distributed positional inverted index.

Words are runs of letters, digits and non-ASCII characters of the ASCII-lower-cased text. The windows of a benchmark
item are its runs of `width` consecutive words; an item of fewer words, but not none, is one window. First the corpus
frequency of every test term is counted over all documents; windows with a term that occurs nowhere are done with. The
index then stores the postings (term, document, position) of the two rarest terms of each window. Their offset-adjusted
lists are intersected (rarest first), which leaves candidate places; these are checked against the words themselves, so
the result is exact. Words inside any occurrence of a window are hit. Where the two rarest terms of a window stand at most
`within` words apart, in either order, the document has a proximity match with the window's items. Long texts are taken
whole. Documents are split into words three times: to count the test terms, for the postings, and for the result, where
those without a match are only counted. Texts meet their matches by a shuffle at every size, as matches grow with the corpus.

Nulls: a null text has no words; a null item_id counts as an empty string. Empty texts have no words and no windows.
Repeated documents each get their own, equal result; repeated items count once by item_id. Without items nothing is
hit; without documents the result is empty. Columns beside doc_id, text, item_id are ignored by find().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, pack, small, table, unpack

WIDTH = 10
#: Words between the two rarest terms of a window at most, for a proximity match.
WITHIN = 20
#: ASCII characters that are no letters (in lower case) or digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with a 128-bit key of doc_id and text, equal for equal rows and never null."""
    return docs.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit(7), "text", "doc_id")})


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows: window (array of words), items (ids that have it)."""
    item = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    each = item.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, width))).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences in all documents of the given terms: term, n."""
    tokens = docs.select(F.explode(F.split(ascii_lower(F.col("text")), SEPARATORS)).alias("term"))
    return tokens.join(small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def anchors(distinct_windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with their two rarest: term_a at offset_a, term_b at offset_b (0-based)."""
    each = distinct_windows.select("window", "items", F.posexplode("window").alias("offset", "term")).join(counts, "term")
    rare = each.groupBy("window", "items").agg(F.sort_array(F.collect_list(F.struct("n", "offset", "term"))).alias("rare"))
    rare = rare.filter(F.size("rare") == F.size("window"))
    a, b = F.col("rare")[0], F.col("rare")[F.least(F.size("rare"), F.lit(2)) - 1]
    return rare.select(
        "window", "items", a["term"].alias("term_a"), a["offset"].alias("offset_a"), b["term"].alias("term_b"), b["offset"].alias("offset_b")
    )


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: term, k1, k2, position, for the given terms in keyed documents."""
    tokens = docs.select("k1", "k2", F.posexplode(words(F.col("text"))).alias("position", "term"))
    return tokens.join(small(terms), "term").select("term", "k1", "k2", "position")


def intersect(index: DataFrame, sought: DataFrame) -> DataFrame:
    """Places k1, k2, start, window, items where the two rarest terms of a window stand at the right distance."""
    first = index.join(small(sought), F.col("term") == F.col("term_a")).withColumn("start", F.col("position") - F.col("offset_a"))
    first = first.filter("start >= 0").select("k1", "k2", "start", "window", "items", "term_b", (F.col("start") + F.col("offset_b")).alias("position_b"))
    second = index.select("k1", "k2", F.col("term").alias("term_b"), F.col("position").alias("position_b"))
    return first.join(second, ["k1", "k2", "term_b", "position_b"], "left_semi").select("k1", "k2", "start", "window", "items")


def proximity(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """Proximity matches: for pairs (term_a, term_b) of indexed terms, k1, k2, position_a, position_b at most `within` apart.

    Lists meet inside blocks of `within` + 1 positions and their right neighbours, so no list is crossed with another.
    """
    block = within + 1
    a = index.join(small(pairs), F.col("term") == F.col("term_a")).select("k1", "k2", "term_a", "term_b", F.col("position").alias("position_a"))
    near = F.array(*[F.floor(F.col("position_a") / block) + d for d in (-1, 0, 1)])
    a = a.withColumn("block", F.explode(near))
    b = index.select("k1", "k2", F.col("term").alias("term_b"), F.col("position").alias("position_b"))
    b = b.withColumn("block", F.floor(F.col("position_b") / block))
    both = a.join(b, ["k1", "k2", "term_b", "block"])
    apart = F.abs(F.col("position_a") - F.col("position_b"))
    return both.filter((apart <= within) & (apart > 0)).select("k1", "k2", "term_a", "term_b", "position_a", "position_b")


def near_items(index: DataFrame, sought: DataFrame, within: int) -> DataFrame:
    """k1, k2, _near: the items of which a window's two rarest terms stand near each other."""
    of = sought.select("term_a", "term_b", F.explode("items").alias("item")).distinct()
    met = proximity(index, of.select("term_a", "term_b").distinct(), within).select("k1", "k2", "term_a", "term_b").distinct()
    return met.join(small(of), ["term_a", "term_b"]).groupBy("k1", "k2").agg(F.collect_set("item").alias("_near"))


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, within: int | None = None) -> DataFrame:
    """All rows and columns of docs, with n_words, n_hit, items (sorted ids of items with occurring windows) and, if `within`
    is given, near_items (those with a proximity match), which replace columns so named."""
    own = keyed(docs.select("doc_id", "text"))
    distinct_windows = materialize(windows(benchmark, width), "windows")
    terms = distinct_windows.select(F.explode("window").alias("term")).distinct()
    counts = materialize(term_counts(own, terms), "term-counts")
    sought = materialize(anchors(distinct_windows, counts), "anchors")
    rare = sought.select(F.explode(F.array("term_a", "term_b")).alias("term")).distinct()
    # equal documents have equal keys and one list of postings
    index = materialize(postings(own, rare).distinct(), "postings")
    places = intersect(index, sought).distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "window", "items")).alias("_places"))
    if within is None:
        found = places.withColumn("_near", F.array().cast("array<string>"))
    else:
        found = places.join(near_items(index, sought, within), ["k1", "k2"], "full_outer")
    found = materialize(found, "places")
    joined = keyed(pack(docs, "doc_id", "text")).join(found, ["k1", "k2"], "left")
    # one split a document: the words are kept where they are looked at, else only their number
    split = joined.withColumn("_all", F.explode(F.array(words(F.col("text")))))
    full = split.withColumns({"_n_words": F.size("_all"), "_words": F.when(F.col("_places").isNotNull(), F.col("_all"))}).drop("_all")
    here = F.filter("_places", lambda p: F.slice(F.col("_words"), p["start"] + 1, F.size(p["window"])) == p["window"])
    full = full.withColumn("_hits", F.coalesce(F.when(F.col("_places").isNotNull(), here), F.array().cast(found.schema["_places"].dataType)))
    covered = F.array_distinct(F.flatten(F.transform("_hits", lambda p: F.sequence(p["start"], p["start"] + F.size(p["window"]) - 1))))
    new = {
        "n_words": F.col("_n_words").cast("long"),
        "n_hit": F.size(covered).cast("long"),
        "items": F.array_sort(F.array_distinct(F.flatten(F.col("_hits.items")))),
    }
    if within is not None:
        new["near_items"] = F.array_sort(F.coalesce("_near", F.array().cast("array<string>")))
    return unpack(full, docs, **new)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), within=WITHIN)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"),
    )


_WORDS_SQL = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)
ORACLE = f"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS_SQL} AS ws FROM benchmark
), wins AS (
  SELECT DISTINCT item, least(len(ws), {WIDTH}) AS width, unnest(list_transform(range(1, greatest(len(ws) - {WIDTH - 1}, 1) + 1), lambda s: list_slice(ws, s, s + {WIDTH - 1}))) AS win
  FROM items WHERE len(ws) > 0
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS ws FROM documents
), places AS (
  SELECT r, width, unnest(range(1, len(ws) - width + 2)) AS start, unnest(list_transform(range(1, len(ws) - width + 2), lambda s: list_slice(ws, s, s + width - 1))) AS win
  FROM docs, (SELECT DISTINCT width FROM wins)
), found AS (
  SELECT r, start, places.width, item FROM places JOIN wins ON wins.width = places.width AND wins.win = places.win
), hit AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(start, start + width)) AS p FROM found) GROUP BY r
), counts AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(ws) AS term FROM docs) WHERE term IN (SELECT unnest(win) FROM wins) GROUP BY term
), rare AS (
  SELECT win, list((n, i, term) ORDER BY n, i) AS terms FROM (SELECT DISTINCT win, unnest(range(len(win))) AS i, unnest(win) AS term FROM (SELECT DISTINCT win FROM wins)) JOIN counts USING (term) GROUP BY win
), term_pairs AS (
  SELECT DISTINCT terms[1][3] AS term_a, terms[least(len(terms), 2)][3] AS term_b, item FROM rare JOIN wins USING (win) WHERE len(terms) = len(win)
), positions AS (
  SELECT r, term, p FROM (SELECT r, unnest(ws) AS term, unnest(range(len(ws))) AS p FROM docs) WHERE term IN (SELECT term_a FROM term_pairs UNION SELECT term_b FROM term_pairs)
), near AS (
  SELECT r, count(*)::BIGINT AS n_near_items, string_agg(item, ',' ORDER BY item) AS near_names FROM (
    SELECT DISTINCT x.r, item FROM term_pairs JOIN positions x ON x.term = term_a JOIN positions y ON y.term = term_b AND y.r = x.r AND abs(x.p - y.p) BETWEEN 1 AND {WITHIN}) GROUP BY r
), named AS (
  SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(n_near_items, 0)::BIGINT AS n_near_items, sha256(coalesce(near_names, '')) AS near_items_sha256
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN near USING (r)
"""
