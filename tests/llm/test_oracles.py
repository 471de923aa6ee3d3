"""Queries of the subpackage against their SQL."""

import duckdb
import pytest

from lexquarry.llm import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got = registry.queries()[name](spark, folder)
    want = con.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    a = sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(dict(zip(want.columns, r, strict=True))[c] for c in order) for r in want.fetchall()), key=repr)
    assert a == b
