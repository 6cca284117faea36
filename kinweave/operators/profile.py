"""Column profiles of laid-out families: consensus, plurality, distances, medoids, radii. All SQL aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distances are rounded to this many decimals, so that the order of summing can't tip ties.
DECIMALS = 9


def tally(cells: DataFrame) -> DataFrame:
    """clusterId, chain, pos, residue, w."""
    return cells.groupBy("clusterId", "chain", "pos", "residue").agg(F.sum("weight").alias("w"))


def columns(tallied: DataFrame, gap_threshold: float = 0.5) -> DataFrame:
    """clusterId, chain, pos, total, gap_w, best, best_w, shares (weight of each symbol), absent.

    absent: the gaps' share of the column's whole weight exceeds the threshold. best: the residue of most weight, then
    the one of the smaller code point; null in a column of gaps alone.
    """
    residue = F.col("residue") != "-"
    agg = tallied.groupBy("clusterId", "chain", "pos").agg(
        F.sum("w").alias("total"),
        F.coalesce(F.sum(F.when(~residue, F.col("w"))), F.lit(0.0)).alias("gap_w"),
        F.max_by(F.when(residue, F.col("residue")), F.when(residue, F.struct("w", -F.ascii("residue")))).alias("best"),
        F.max(F.when(residue, F.col("w"))).alias("best_w"),
        F.collect_list(F.struct("residue", "w")).alias("shares"),
    )
    absent = F.when(F.col("total") <= 0, True).otherwise(F.col("gap_w") / F.col("total") > F.lit(float(gap_threshold)))
    return agg.withColumn("absent", absent)


def symbol(threshold: float) -> Column:
    """One symbol a column: - if absent, the best residue if its share of the non-gap weight reaches the threshold, else X."""
    rest = F.col("total") - F.col("gap_w")
    return (
        F.when(F.col("absent") | F.col("best").isNull() | (rest <= 0), F.lit("-"))
        .when(F.col("best_w") / rest >= F.lit(float(threshold)), F.col("best"))
        .otherwise(F.lit("X"))
    )


def consensus(cols: DataFrame, threshold: float = 0.6, keep_gaps: bool = False) -> DataFrame:
    """clusterId, chain, consensus, l_cons (columns that aren't absent)."""
    symbols = F.array_sort(F.collect_list(F.struct("pos", symbol(threshold).alias("s"))))
    joined = F.array_join(F.transform(symbols, lambda x: x["s"]), "")
    text = joined if keep_gaps else F.replace(joined, F.lit("-"), F.lit(""))
    return cols.groupBy("clusterId", "chain").agg(text.alias("consensus"), F.count_if(~F.col("absent")).alias("l_cons"))


def families(cols: DataFrame, threshold: float = 0.6, keep_gaps: bool = False) -> DataFrame:
    """clusterId, chain, consensus, l_cons, costs: for each column, 1 - the share of each of its symbols."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", symbol(threshold).alias("s"), "total", "shares")))
    cost = lambda x: F.map_from_entries(F.transform(x["shares"], lambda r: F.struct(r["residue"], 1 - r["w"] / F.nullif(x["total"], F.lit(0.0)))))
    joined = F.array_join(F.transform(F.col("_cols"), lambda x: x["s"]), "")
    text = joined if keep_gaps else F.replace(joined, F.lit("-"), F.lit(""))
    grouped = cols.groupBy("clusterId", "chain").agg(ordered.alias("_cols"), F.count_if(~F.col("absent")).alias("l_cons"))
    return grouped.select("clusterId", "chain", text.alias("consensus"), "l_cons", F.transform("_cols", cost).alias("costs"))


def member_distances(laid: DataFrame, profiles: DataFrame) -> DataFrame:
    """clusterId, chain, seq, d: the sum over all columns of 1 - the share of the member's own symbol.

    laid: members with their rows; profiles: families(). One join on the family; no cell is shuffled.
    """
    joined = laid.select("clusterId", "chain", "seq", "row").join(profiles.select("clusterId", "chain", "costs"), ["clusterId", "chain"])
    each = F.zip_with(F.split("row", ""), F.col("costs"), lambda r, cost: F.coalesce(cost[r], F.lit(0.0)))
    return joined.select("clusterId", "chain", "seq", F.aggregate(each, F.lit(0.0), lambda sum_, x: sum_ + x).alias("d"))


def distance_parts(rows: DataFrame, distances: DataFrame, lengths: DataFrame) -> DataFrame:
    """clusterId, clonotypeKey, weight, sum_d, sum_norm, n_chains, seq_key over the chains a member has.

    A member that was left out of the layout is charged its whole length. lengths: (clusterId, chain, l_cons).
    """
    n = F.length("raw").cast("double")
    joined = rows.join(distances, ["clusterId", "chain", "seq"], "left").join(lengths, ["clusterId", "chain"])
    return joined.groupBy("clusterId", "clonotypeKey").agg(
        F.max("weight").alias("weight"),
        F.sum(F.coalesce("d", n)).alias("sum_d"),
        F.sum(F.greatest(F.col("l_cons").cast("double"), n)).alias("sum_norm"),
        F.count_if(F.col("l_cons") > 0).alias("n_chains"),
        F.array_sort(F.collect_list(F.struct("chain", "raw"))).alias("parts"),
    )


def distance_to_centroid(parts: DataFrame) -> DataFrame:
    """clusterId, clonotypeKey, distanceToCentroid in 0 to 1."""
    d = F.when(F.col("sum_norm") > 0, F.least(F.lit(1.0), F.col("sum_d") / F.col("sum_norm"))).otherwise(F.lit(0.0))
    return parts.select("clusterId", "clonotypeKey", F.round(d, DECIMALS).alias("distanceToCentroid"))


def medoids(parts: DataFrame, lengths: DataFrame, chains: list[str]) -> DataFrame:
    """clusterId, medoid_key: the member of least summed distance, then most weight, then least joined sequence and key.

    Members that lack a chain which the family has come last, so they are taken only where no member is complete.
    """
    present = lengths.filter("l_cons > 0").groupBy("clusterId").agg(F.count(F.lit(1)).alias("n_present"))
    by_chain = F.map_from_entries("parts")
    joined = F.concat_ws("====", *[F.coalesce(F.element_at(by_chain, F.lit(c)), F.lit("")) for c in chains])
    ranked = parts.join(present, "clusterId", "left").withColumn("text", joined)
    order = F.struct(
        (F.col("n_chains") < F.coalesce("n_present", F.lit(0))).alias("lacks"), F.round("sum_d", DECIMALS).alias("d"), (-F.col("weight")).alias("w"), "text", "clonotypeKey"
    )
    return ranked.groupBy("clusterId").agg(F.min_by("clonotypeKey", order).alias("medoid_key"))


def cluster_radius(distances: DataFrame) -> DataFrame:
    return distances.groupBy("clusterId").agg(F.max("distanceToCentroid").alias("clusterRadius"))
