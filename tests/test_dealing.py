"""Steps whose tasks keep their size while tables grow."""

import duckdb
import pytest

from lexquarry.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["agency_derivation_join", "bill_edges", "bill_transform", "coverage_report", "stress_invariants"])
def test_partitions_follow_the_rows(spark, monkeypatch, name):
    from lexquarry import dealing

    monkeypatch.setattr(dealing, "ROWS", 250)
    found = QUERIES[name](spark, FOLDER)
    con = duckdb.connect()
    for t in ("nation", "supplier", "orders", "lineitem", "events", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, con.sql(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    assert f", {-(-rows // 250)})" in plan.replace("REPARTITION_BY_NUM", "") or f", {-(-rows // 250)}), " in plan


def test_rows_of_either_side_and_null_keys(spark):
    from lexquarry.operators import joins

    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a long")
    right = spark.createDataFrame([(2,), (3,), (None,), (None,)], "b long")
    assert {tuple(r) for r in joins.sides(left, right).collect()} == {(1, 2, 0), (2, 1, 1), (3, 0, 1), (None, 1, 2)}
