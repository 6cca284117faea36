"""Parameters, catalog, files, streaming, the whole analysis, and queries against their SQL."""

from __future__ import annotations

import importlib.util
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from kinweave import catalog, storage
from kinweave.operators.scoring import level_matrix
from kinweave.params import ClusterParams, prune_selection, suggest_similarity, warnings
from kinweave.plans import analysis, oracles, views
from kinweave.plans import queries as family
from kinweave.schemas import clone_table, result_schemas
from kinweave.sources import files, tables
from kinweave.streaming import rollup as stream

SF = "/root/testdata/sf0.001"


def test_params():
    p = ClusterParams.from_dict({"identity": 0.9, "unknown": 1, "trimEnd": None, "sequencesRef": ["a"]})
    assert p.identity == 0.9 and p.trimEnd == 0
    assert ClusterParams.from_dict(p.to_dict()) == p
    with pytest.raises(ValueError, match="identity='high'"):
        ClusterParams.from_dict({"identity": "high"})
    old = ClusterParams.upgrade({"similarityType": "alignment-score"})
    assert (old.similarityType, old.centroidAlignment) == ("blosum62", "gapped")
    assert not ClusterParams(clusteringTool="easy-linclust", highPrecision=True).effective().highPrecision
    with pytest.raises(ValueError):
        p.runnable()
    assert ClusterParams(customBlockLabel="mine").label() == "mine" and ClusterParams().label() == "BLOSUM62, ident:0.8, cov:0.8"
    assert ClusterParams(similarityType="sequence-identity", trimEnd=2, centroidAlignment="gapped").label(("CDR3", "FR1")) == "CDR3 - FR1, Exact Match, ident:0.8, cov:0.8, trimEnd: 2, gapped"
    assert prune_selection(["a", "b"], ["b", "c"]) == ["b"]
    assert all(ClusterParams.from_dict({k: v}) for k, v in {"coverageMode": 3, "trimStart": 2, "identity": 1, "mem": 8.5}.items())
    for wrong in ({"coverageMode": 6}, {"coverageMode": True}, {"highPrecision": 1}, {"sequencesRef": [1]}, {"clusteringTool": "other"}, {"trimEnd": "1"}):
        with pytest.raises(ValueError):
            ClusterParams.from_dict(wrong)
    assert suggest_similarity(["FR1", "FR3"]) == "blosum80" and suggest_similarity(["CDR3"]) == "blosum62"
    assert warnings(True, None, True) and warnings(False, 3, True) and not warnings(False, 9, True)


def test_catalog(spark):
    assert catalog.percent_text(0.35) == "35" and catalog.centroid_domain(ClusterParams())["clustering/weighting"] in ("abundance", "equal")
    table = catalog.missing_chain_join(spark.createDataFrame([("a",)], "clonotypeKey string"), {"sequence_0": spark.createDataFrame([("b", "X")], "clonotypeKey string, value string")})
    assert {(r.clonotypeKey, r.sequence_0) for r in table.collect()} == {("a", ""), ("b", "X")}


def test_files(spark, tmp_path):
    rows = [("s1", "k1", 3, "NA", "C-1"), ("s1", "k2", 1, None, "C-2")]
    df = spark.createDataFrame(rows, clone_table(1))
    files.write_tsv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, files.read_tsv(spark, str(tmp_path / "t"), clone_table(1)).collect()), key=str) == sorted(rows, key=str)
    files.write_frame(df, str(tmp_path / "p"), ["sampleId", "clonotypeKey"], 1)
    assert (tmp_path / "p" / "sampleId=s1").exists()
    with pytest.raises(ValueError, match="2 rows have 1 keys"):
        files.write_frame(df, str(tmp_path / "q"), ["sampleId"])
    typed = files.import_frame(files.read_strings(spark, str(tmp_path / "t"), df.columns), {"sampleId": "string"}, {"abundance": "long"})
    assert typed.dtypes == [("sampleId", "string"), ("abundance", "bigint")] and {r.abundance for r in typed.collect()} == {1, 3}
    with pytest.raises(ValueError, match="absent"):
        files.import_frame(df, {"absent": "string"}, {})
    files.write_content(df.selectExpr("count(*) AS n"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["n"] == 2
    reps = spark.createDataFrame([("k1", "ACD"), ("k2", "EF")], "clonotypeKey string, sequence string")
    files.write_fasta(reps, str(tmp_path / "f"))
    assert {tuple(r) for r in files.read_fasta(spark, str(tmp_path / "f")).collect()} == {("k1", "ACD"), ("k2", "EF")}
    odd = {f"k{i}>{i}|> x": "ACDEFGHIKL" * (i % 7 + 1) for i in range(400)}
    (tmp_path / "odd.fasta").write_text("\n" + "\n".join(f">s-{k}\r\n" + "\n".join(s[j : j + 9] for j in range(0, len(s), 9)) for k, s in odd.items()) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        read = files.read_fasta(spark, str(tmp_path / "odd.fasta"))
        assert read.rdd.getNumPartitions() > 5 and {tuple(r) for r in read.collect()} == set(odd.items())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "c.tsv").write_text("s-k1\ts-k1\ns-k1\ts-k2\n")
    assert [tuple(r) for r in files.read_clusters(spark, str(tmp_path / "c.tsv")).collect()] == [("k1", "k1"), ("k1", "k2")]


def _clones(spark):
    seqs = {"a": "CASSLGETQYFW", "b": "CASSLAETQYFW", "c": "CASSLGETQYFW", "d": "KKKKKKKK", "e": "", "f": "CASSLGETQYYW"}
    return spark.createDataFrame([(s, k, n + 1, v or None, f"C-{k}") for s in ("s1", "s2") for n, (k, v) in enumerate(seqs.items())], clone_table(1))


@pytest.mark.parametrize("params", [{}, {"trimEnd": 2, "weightByAbundance": True, "generateDataset": True}, {"clusteringTool": "easy-linclust"}, {"highPrecision": True}, {"similarityType": "sequence-identity"}])
def test_analysis(spark, params):
    out = analysis.analyse(_clones(spark), ClusterParams.from_dict(params), matrix=level_matrix(62))
    for name, schema in result_schemas(1).items():
        assert set(out[name].columns) == set(schema.names), name
    link = {r.clonotypeKey: r.clusterId for r in out["clone-to-cluster"].collect()}
    assert link["a"] == link["c"] == link["b"] == link["f"] and link["d"] == "d" and "e" not in link
    top = {r.clusterId: r for r in out["cluster-to-seq"].collect()}
    assert top["d"].centroid_sequence_0 == "KKKKKKKK" and top[link["a"]].size == 4
    assert all(0 <= r.distanceToCentroid <= 1 for r in out["distance_to_centroid"].collect())
    assert sum(r.abundance_fraction_per_cluster for r in out["abundances-per-cluster"].collect()) == pytest.approx(1)
    keys = out["trimmed-sequences"]
    counted = {
        "clone_rows": _clones(spark).count(), "keys": keys.count(), "emptied_sequences": keys.filter("trimmed_fullSequence = ''").count(),
        "members": out["clone-to-cluster"].count(), "dropped_members": out["dropped-members"].count(),
    }
    assert {k: out.metrics[k] for k in counted} == counted and out.metrics.get("reassigned_singletons", 0) in range(3)
    assert ("reassigned_singletons" in out.metrics) == ("highPrecision" in params)


def test_scored_similarity(spark):
    """Replacements within a group of residues count less under a matrix than as edits."""
    reps = spark.createDataFrame([("a", "ACDEFGHIKLMACDEFGHIKLM"), ("b", "ACDEFGHIKLMGCDEFGHIKLI"), ("c", "WWWWWWWWWW"), ("d", "ACDE")], "clonotypeKey string, sequence string")
    made = lambda m, **p: {r.clonotypeKey: r.clusterId for r in analysis.cluster_representatives(reps, ClusterParams(coverageThreshold=0.5, **p), m).collect()}
    assert made(None, identity=0.92, similarityType="sequence-identity") == {k: k for k in "abcd"}
    for p in ({}, {"highPrecision": True}, {"clusteringTool": "easy-linclust"}):
        got = made(level_matrix(62), identity=0.92, similarityType="blosum62", **p)
        assert got["a"] == got["b"] and got["c"] == "c" and got["d"] == "d"


def test_clone_table_needs_labels(spark):
    with pytest.raises(ValueError):
        tables.join_clone_table(_clones(spark), _clones(spark), None)


def test_stored_tables_can_be_dropped(spark):
    from pathlib import Path

    storage.drop_stored(spark)
    df = storage.stored(spark.range(3))
    folder = Path(df.inputFiles()[0].removeprefix("file://")).parent
    assert df.count() == 3 and folder.exists() and storage.drop_stored(spark) == 1 and not folder.exists()


def test_empty_analysis(spark):
    out = analysis.analyse(_clones(spark).limit(0), ClusterParams())
    assert out.input_empty and all(out[name].count() == 0 for name in result_schemas(1))


def test_anonymise(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "sampleId string, n int")
    hidden, mapping = views.anonymise(df, "sampleId")
    assert {r.sampleId for r in hidden.collect()} == {"S1", "S2"}
    assert "exchange SinglePartition" not in mapping._jdf.queryExecution().executedPlan().toString()
    many = spark.range(5000).select(F.format_string("s%05d", "id").alias("sampleId"))
    assert {(r.anonymised, r.original) for r in views.anonymise(many, "sampleId")[1].collect()} == {(f"S{i + 1}", f"s{i:05d}") for i in range(5000)}
    assert {tuple(r) for r in views.deanonymise(hidden, "sampleId", mapping).select("sampleId", "n").collect()} == {("x", 1), ("y", 2)}


def test_stream(spark, tmp_path):
    rows = _clones(spark)
    rows.write.parquet(str(tmp_path / "in"))
    clusters = spark.createDataFrame([("a", k) for k in "abc"], "clusterId string, clonotypeKey string")
    q = stream.start(stream.abundance_stream(spark, str(tmp_path / "in"), rows.schema, clusters), "running", str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert {(r.sampleId, r.abundance) for r in spark.table("running").collect()} == {("s1", 6), ("s2", 6)}


@pytest.mark.parametrize("name", ["clone_table", "full_sequence_concat", "abundances", "consensus_centroid", "medoid_reference", "connected_components", "cluster_size_histogram", "linear_time_clusters", "neighbour_pairs", "diagonal_candidates"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    want = con.sql(__spark_entry__.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    clean = lambda v: round(v, 7) if isinstance(v, float) else v
    got = sorted(str([clean(r[c]) for c in cols]) for r in df.collect())
    assert got == sorted(str([clean(r[i]) for i in at]) for r in want.fetchall())


@pytest.mark.parametrize("name", ["set_cover_clusters", "linear_time_clusters"])
def test_all_words_stay(spark, tmp_path, name):
    words = ["aaaaaaaaaaaaaaaé", "aaaaaaaaaaaaaaaè", "жжжжж", "ддддд", "plain"]
    spark.createDataFrame([("x", " ".join(words))], "lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.clusterId, r.clonotypeKey) for r in __spark_entry__.queries()[name](spark, str(tmp_path)).collect()}
    # brute force: one letter of sixteen makes neighbours, any other two words are apart
    assert len(got) == 5 and {k for _, k in got} == {f"k-{w}" for w in words}
    assert {c for c, _ in got} == {"k-aaaaaaaaaaaaaaaè", "k-жжжжж", "k-ддддд", "k-plain"}


def test_registry():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_registry_without_the_subpackage(monkeypatch):
    """The family queries stay where kinweave/llm is gone and corpus_pipeline.py is still there."""
    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name.startswith("kinweave.llm") else found(name, *a))
    assert set(__spark_entry__.queries()) == set(family.QUERIES)
    assert set(__spark_entry__.oracle_sql()) == set(oracles.ORACLES)
