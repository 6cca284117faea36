"""Queries of this round against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from kinweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op7_positional_index", "op11_shared_list_negatives", "op13_bit_sliced_variants"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    want = found.fetchall()
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()]
    assert len(want) > 0 and sorted(map(str, got)) == sorted(map(str, want))
