"""Merkle fixity audit of WARC replicas.

Pages become WARC response records; records follow each other in archive files, each at a byte offset. Every archive is
audited by its own manifest, which is made from the lengths of its own records: (file_id, offset, length, record_id,
digest). A leaf is one record: the SHA-256 of its file, offset, length and digest. The lowest nodes cover ranges of
`span` bytes of a file, those above `fan_out` consecutive ranges, then files and runs of files, up to one root; a node's
digest is the SHA-256 of its children's in order. Two archives are compared at the root; below, only children of nodes
that differ are joined and compared, down to the ranges, whose records are then matched.

Findings: `altered` (another digest under the same id at the same place), `moved` (the same id and digest at another
place), `missing` (only the primary has it), `extra` (only the replica has it). Equal records that lack their place are
paired in the order of their places. A whole range without records on one side differs like any other.

Nulls: a null url or html counts as empty, a null page_id is written as an empty id, comes first, and matches other null
ids only. Repeated pages are records of their own. Empty and very long texts are records like others; a range never
holds more than span / 100 records, as no record is shorter than its headers. Empty archives give no findings. Columns
beside page_id, url and html, or those of a manifest, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import div, levels, materialize, row_numbers, table

FAN_OUT = 64
PER_FILE = 4096
#: Bytes of a file that a lowest node covers.
SPAN = 1 << 16
_PLACE = ["file_id", "offset"]


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC/1.1 response record, as a string."""
    body, ident = F.coalesce(html, F.lit("")), F.coalesce(page_id.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), ident, F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def offsets(stream: DataFrame) -> DataFrame:
    """The stream (file_id, ordinal, length, ...) with the offset at which each entry of a file begins.

    A file is read from its begin to its end, so one file is one group; archive files are of bounded size.
    """
    before = W.partitionBy("file_id").orderBy("ordinal").rowsBetween(W.unboundedPreceding, -1)
    return stream.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))


def manifest(records: DataFrame, order: list[str], per_file: int = PER_FILE) -> DataFrame:
    """Places of a new archive: `records` (narrow, with `length`) and ordinal, file_id, offset."""
    rows, _ = row_numbers(records, order, "ordinal", "warc-manifest")
    return offsets(rows.withColumn("file_id", div(F.col("ordinal"), per_file)))


def ranges(archive: DataFrame, span: int = SPAN) -> DataFrame:
    """The lowest nodes of an archive's tree: file_id, node (number of the range), digest."""
    leaf = F.sha2(F.concat_ws("|", "file_id", "offset", "length", "digest"), 256)
    at = div(F.col("offset"), span).alias("node")
    ordered = F.sort_array(F.collect_list(F.struct("offset", leaf.alias("leaf"))))
    grouped = archive.groupBy("file_id", at).agg(ordered.alias("leaves"))
    return grouped.select("file_id", "node", F.sha2(F.array_join(F.col("leaves.leaf"), "\n"), 256).alias("digest"))


def _parent(step: str, fan_out: int) -> list[Column]:
    """What names the parent of a node (file_id, node): inside its file, or among runs of files."""
    if step == "ranges":
        return [F.col("file_id").alias("file_id"), div(F.col("node"), fan_out).alias("node")]
    return [div(F.col("file_id"), fan_out).alias("file_id"), F.lit(0).cast("long").alias("node")]


def tree(low: DataFrame, steps: list[str], fan_out: int = FAN_OUT) -> list[DataFrame]:
    """All levels (file_id, node, digest) from the lowest to the root."""
    out = [low]
    for step in steps:
        child = F.struct("file_id", "node", "digest")
        parents = [c.alias(f"_{k}") for k, c in enumerate(_parent(step, fan_out))]
        grouped = out[-1].select(child.alias("child"), *parents).groupBy("_0", "_1").agg(F.sort_array(F.collect_list("child")).alias("children"))
        out.append(grouped.select(F.col("_0").alias("file_id"), F.col("_1").alias("node"), F.sha2(F.array_join(F.col("children.digest"), "\n"), 256).alias("digest")))
    return out


def differing(a: list[DataFrame], b: list[DataFrame], steps: list[str], fan_out: int = FAN_OUT) -> DataFrame:
    """Lowest nodes (file_id, node) that differ between two trees of the same shape, found from the root downwards."""
    suspects = None
    for depth in range(len(a) - 1, -1, -1):
        left, right = a[depth], b[depth]
        if suspects is not None:
            up = [c.alias(f"_{k}") for k, c in enumerate(_parent(steps[depth], fan_out))]
            above = suspects.select(F.col("file_id").alias("_0"), F.col("node").alias("_1"))
            left, right = (side.select("*", *up).join(above, ["_0", "_1"], "left_semi") for side in (left, right))
        x, y = (side.select("file_id", "node", F.col("digest").alias(name)) for side, name in ((left, "_x"), (right, "_y")))
        suspects = x.join(y, ["file_id", "node"], "full_outer").filter(~F.col("_x").eqNullSafe(F.col("_y"))).select("file_id", "node")
    return suspects


_MANIFEST = ["file_id", "offset", "length", "record_id", "digest"]


def audit(primary: DataFrame, replica: DataFrame, fan_out: int = FAN_OUT, span: int = SPAN) -> DataFrame:
    """record_id, file_id, offset, length, digest, the same of the replica (replica_*), finding.

    Both are manifests, stored tables by preference; file_id and offset are a key of each and not negative.
    """
    primary, replica = primary.select(*_MANIFEST), replica.select(*_MANIFEST)
    most = primary.unionByName(replica).agg(F.max(div(F.col("offset"), span)).alias("node"), F.max("file_id").alias("file")).first()
    steps = ["ranges"] * levels((most["node"] or 0) + 1, fan_out) + ["files"] * levels((most["file"] or 0) + 1, fan_out)
    trees = [tree(materialize(ranges(side, span), f"merkle-{name}"), steps, fan_out) for side, name in ((primary, "primary"), (replica, "replica"))]
    suspects = materialize(differing(*trees, steps, fan_out), "merkle-suspects").select(F.col("file_id").alias("_file"), F.col("node").alias("_node"))

    def suspect(side: DataFrame, prefix: str) -> DataFrame:
        at = (F.col("file_id") == F.col("_file")) & (div(F.col("offset"), span) == F.col("_node"))
        found = side.join(suspects, at, "left_semi")
        return found.select(*[F.col(c).alias(c if c in _PLACE else prefix + c) for c in _MANIFEST])

    both = suspect(primary, "p_").join(suspect(replica, "r_"), _PLACE, "full_outer")
    both = both.filter(~(F.col("p_digest").eqNullSafe(F.col("r_digest")) & F.col("p_length").eqNullSafe(F.col("r_length"))))
    both = materialize(both, "merkle-records")
    here = F.col("p_digest").isNotNull() & F.col("r_digest").isNotNull() & F.col("p_record_id").eqNullSafe(F.col("r_record_id"))
    altered = both.filter(here).select(
        F.col("p_record_id").alias("record_id"), "file_id", "offset", F.col("p_length").alias("length"), F.col("p_digest").alias("digest"),
        F.col("file_id").alias("replica_file_id"), F.col("offset").alias("replica_offset"), F.col("r_length").alias("replica_length"),
        F.col("r_digest").alias("replica_digest"), F.lit("altered").alias("finding"),
    )
    # the rest lack their place: equal records of both sides are paired in order of their places, whatever their number
    apart = both.filter(~here)
    rows = [
        apart.filter(F.col(f"{s}_digest").isNotNull()).select(F.lit(side).alias("side"), F.col(f"{s}_record_id").alias("record_id"), F.col(f"{s}_digest").alias("digest"), *_PLACE, F.col(f"{s}_length").alias("length"))
        for side, s in enumerate("pr")
    ]
    numbered, _ = row_numbers(rows[0].unionByName(rows[1]), ["side", "record_id", "digest", *_PLACE], name="merkle-apart")
    first = numbered.groupBy("side", "record_id", "digest").agg(F.min("row_number").alias("_first"))
    same = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("record_id", "digest")], F.col("record_id").isNull().alias("none"))
    starts = first.select(F.col("side").alias("_side"), same.alias("_same"), "_first")
    placed = numbered.select("*", same.alias("_same")).join(starts, "_same").filter("side = _side").withColumn("k", F.col("row_number") - F.col("_first"))
    left = placed.filter("side = 0").select("_same", "k", "record_id", *_PLACE, "length", "digest")
    right = placed.filter("side = 1").select("_same", "k", *[F.col(c).alias(f"replica_{c}") for c in ("record_id", *_PLACE, "length", "digest")])
    finding = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("moved")
    others = left.join(right, ["_same", "k"], "full_outer").select(
        F.coalesce("record_id", "replica_record_id").alias("record_id"), *_PLACE, "length", "digest",
        "replica_file_id", "replica_offset", "replica_length", "replica_digest", finding.alias("finding"),
    )
    return altered.unionByName(others)


#: Damage done to the query's replica, by page_id modulo 97; other pages are copied as they are.
LOST, ALTERED, MOVED, DOUBLED = 13, 57, 71, 31


def damaged(pages: DataFrame) -> DataFrame:
    """The stream of a damaged replica: file_id, ordinal, length, record_id, digest; fillers have no digest.

    pages: ordinal, file_id, length, record_id, digest, altered (digest of the record with another version in its first
    line, as long as the right one), files (number of the primary's files). Where a record is lost or was moved away, its
    bytes are blank; moved and doubled records stand in files of their own behind the others.
    """
    kind = F.coalesce("record_id", F.lit(-1)) % 97
    read = F.when(kind == ALTERED, F.col("altered")).when(~kind.isin(LOST, MOVED), F.col("digest"))
    own = pages.select("file_id", "ordinal", "length", "record_id", read.alias("digest"))
    behind = pages.filter(kind.isin(MOVED, DOUBLED))
    return own.unionByName(behind.select((F.col("file_id") + F.col("files")).alias("file_id"), "ordinal", "length", "record_id", "digest"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit the archive of all pages against a replica with known damage; one row for each finding."""
    pages = table(spark, sf_dir, "pages")
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    narrow = pages.select(
        F.col("page_id").alias("record_id"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
        F.sha2(F.overlay(record, F.lit("WARC/1.0"), F.lit(1)), 256).alias("altered"),
    )
    primary = materialize(manifest(narrow, ["record_id", "digest"]), "warc-primary")
    files = primary.agg(F.coalesce(F.max("file_id") + 1, F.lit(0).cast("long")).alias("n")).first()["n"]
    replica = materialize(offsets(damaged(primary.withColumn("files", F.lit(files)))).filter("digest IS NOT NULL"), "warc-replica")
    return audit(primary, replica).drop("length", "replica_length")


def _record_sql(html: str) -> str:
    body = f"coalesce({html}, '')"
    nl = "chr(13) || chr(10)"
    return (
        f"'WARC/1.1' || {nl} || 'WARC-Type: response' || {nl} || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || {nl} || "
        f"'WARC-Target-URI: ' || coalesce(url, '') || {nl} || 'Content-Type: text/html' || {nl} || 'Content-Length: ' || octet_length(encode({body})) || "
        f"{nl} || {nl} || {body} || {nl} || {nl}"
    )


_OFFSET_SQL = 'coalesce(sum(length) OVER (PARTITION BY file_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"'
ORACLE = f"""
WITH r AS (
  SELECT page_id AS record_id, coalesce(page_id, -1) % 97 AS kind, {_record_sql('html')} AS rec FROM pages
), d AS (
  SELECT record_id, kind, rec, octet_length(encode(rec))::BIGINT AS length, sha256(rec) AS digest FROM r
), o AS (
  SELECT *, row_number() OVER (ORDER BY record_id NULLS FIRST, digest) - 1 AS ordinal FROM d
), f AS (
  SELECT *, ordinal // {PER_FILE} AS file_id, (SELECT (count(*) + {PER_FILE - 1}) // {PER_FILE} FROM o) AS files FROM o
), p AS (
  SELECT record_id, file_id, length, digest, {_OFFSET_SQL} FROM f
), stream AS (
  SELECT record_id, file_id, ordinal, length,
    CASE WHEN kind IN ({LOST}, {MOVED}) THEN NULL WHEN kind = {ALTERED} THEN sha256('WARC/1.0' || substr(rec, 9)) ELSE digest END AS digest FROM f
  UNION ALL SELECT record_id, file_id + files, ordinal, length, digest FROM f WHERE kind IN ({MOVED}, {DOUBLED})
), c AS (
  SELECT * FROM (SELECT record_id, file_id, length, digest, {_OFFSET_SQL} FROM stream) WHERE digest IS NOT NULL
), b AS (
  SELECT p.record_id AS pi, p.file_id AS pf, p."offset" AS po, p.digest AS pd, c.record_id AS ci, c.file_id AS cf, c."offset" AS co, c.digest AS cd
  FROM p FULL JOIN c ON p.file_id = c.file_id AND p."offset" = c."offset" WHERE p.digest IS DISTINCT FROM c.digest
), x AS (
  SELECT pi AS i, pd AS d, pf AS f, po AS o, row_number() OVER (PARTITION BY pi, pd ORDER BY pf, po) AS k FROM b
  WHERE pd IS NOT NULL AND (cd IS NULL OR pi IS DISTINCT FROM ci)
), y AS (
  SELECT ci AS i, cd AS d, cf AS f, co AS o, row_number() OVER (PARTITION BY ci, cd ORDER BY cf, co) AS k FROM b
  WHERE cd IS NOT NULL AND (pd IS NULL OR pi IS DISTINCT FROM ci)
)
SELECT pi AS record_id, pf AS file_id, po AS "offset", pd AS digest, cf AS replica_file_id, co AS replica_offset, cd AS replica_digest, 'altered' AS finding
FROM b WHERE pd IS NOT NULL AND cd IS NOT NULL AND pi IS NOT DISTINCT FROM ci
UNION ALL
SELECT coalesce(x.i, y.i), x.f, x.o, x.d, y.f, y.o, y.d, CASE WHEN y.d IS NULL THEN 'missing' WHEN x.d IS NULL THEN 'extra' ELSE 'moved' END
FROM x FULL JOIN y ON x.i IS NOT DISTINCT FROM y.i AND x.d = y.d AND x.k = y.k
"""
