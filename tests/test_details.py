"""Nested records: pages of hot entities, null and repeated keys, and plans without a shuffle."""

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import details


@pytest.fixture(scope="module")
def built(spark):
    entities = spark.createDataFrame([("a", "A", 1), ("b", "B", 2), ("b", "A2", 9), (None, "N", 3), ("z", "Z", 4)], "id string, title string, layer int")
    chunks = spark.createDataFrame([("a", i % 25, f"t{i}") for i in range(25)] + [("b", 1, None), (None, 1, "lost"), ("q", 1, "of none")], "id string, pos int, text string").repartition(3)
    relations = spark.createDataFrame([("a", "cites", "b"), ("a", "cites", "b"), ("b", "amends", "y"), (None, "cites", "b")], "src string, relationship string, dst string")
    old, details.PAGE = details.PAGE, 10
    both = details.two_ways(relations, entities, "id", ["title", "layer"])
    yield details.build_details(entities, "id", {"chunks": (chunks, ["pos"]), "relations": (both, ["direction", "related"])})
    details.PAGE = old


def test_records(built):
    got = {(r.id, r.page): r for r in details.records(built).collect()}
    assert set(got) == {("a", 0), ("a", 1), ("a", 2), ("b", 0), ("z", 0)}
    assert [len(got["a", p].chunks) for p in range(3)] == [10, 10, 5] and {got["a", p].n_pages for p in range(3)} == {3}
    assert [c.pos for p in range(3) for c in got["a", p].chunks] == list(range(25))
    assert got["b", 0].entity.title == "A2"  # the least of the repeated rows
    assert [tuple(x) for x in got["b", 0].relations] == [("inbound", "cites", "a", "A", 1), ("outbound", "amends", "y", "y", None)]
    assert [tuple(x) for x in got["a", 0].relations] == [("outbound", "cites", "b", "A2", 9)] and got["a", 1].relations == []
    assert got["z", 0].chunks == [] and got["z", 0].relations == []


def test_one_record(built):
    (r,) = details.records(built, ("a", 1)).collect()
    assert r.page == 1 and [c.pos for c in r.chunks] == list(range(10, 20))
    assert details.records(built, ("nobody", 0)).count() == 0


def test_no_shuffle_and_one_bucket(spark, built):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = details.records(built)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
        one = details.records(built, ("a", 1))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in one and one.count("SelectedBucketsCount: 1 out of 4") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_entity_with_half_of_all_rows_lies_in_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(details, "PAGE", 100)
    rows = spark.range(8000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("n"))
    made = details.build_details(rows.select("key", F.lit(1).alias("x")).distinct(), "key", {"rows": (rows, ["n"])})
    found = details.records(made)
    assert found.where("key = 0").count() == 40 and found.agg(F.max(F.size("rows"))).first()[0] == 100
    assert found.agg(F.sum(F.size("rows"))).first()[0] == 8000


def test_no_entities_and_no_children(spark):
    none = spark.createDataFrame([], "key long, n long")
    some = spark.createDataFrame([(1, 5)], "key long, n long")
    assert details.records(details.build_details(none, "key", {"rows": (some, ["n"])})).count() == 0
    (r,) = details.records(details.build_details(some, "key", {"rows": (none, ["n"])})).collect()
    assert r.rows == [] and r.n_pages == 1
    assert details.records(details.build_details(some, "key", {})).count() == 1


def test_only_large_entities_are_numbered(spark, monkeypatch):
    from lexquarry.operators import details

    counted, plain = [], details.numbered
    monkeypatch.setattr(details, "numbered", lambda df, *a: counted.append(df.count()) or plain(df, *a))
    monkeypatch.setattr(details, "PAGE", 10)
    entities = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "key string, title long")
    few = spark.createDataFrame([("a", k) for k in range(10)] + [("c", 5)], "key string, at long")
    many = spark.createDataFrame([("a", k) for k in range(25)] + [("b", 7)], "key string, at long")
    built = details.build_details(entities, "key", {"few": (few, ["at"]), "many": (many, ["at"])})
    got = {(r.key, r.page): ([x["at"] for x in r.few], [x["at"] for x in r.many], r.n_pages) for r in details.records(built).collect()}
    assert counted == [25]
    assert got == {("a", 0): ([*range(10)], [*range(10)], 3), ("a", 1): ([], [*range(10, 20)], 3), ("a", 2): ([], [*range(20, 25)], 3), ("b", 0): ([], [7], 1), ("c", 0): ([5], [], 1)}
