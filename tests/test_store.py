from datetime import datetime, timedelta

import pytest

from lexquarry.streaming import store

T0 = datetime(2024, 1, 1)


def _at(s):
    return T0 + timedelta(seconds=s)


def put(key, s, value, keep=100, version="v1"):
    return (key, "put", _at(s), value, version, keep, None)


def get(key, s, asked=None, version="v1"):
    return (key, "get", _at(s), None, version, None, asked)


BATCHES = [
    [put("a", 0, "Alpha one"), get("a", 10), get("b", 10), get("a", 10, "ALPHA"), get("a", 11, "zeta"), get("a", 12, version="v2"), put("c", 0, "short", keep=5), get("c", 5)],
    [get("a", 99), put("a", 90, "Alpha two"), put("a", 80, "older"), get("a", 189), get("a", 190), put("n", 150, None, keep=50), get("n", 160, "x"), get("n", 160)],
    [get("a", 1), put("z", 5000, "later"), get("c", 4000)],
]


@pytest.fixture
def run(spark, tmp_path):
    def go(batches, **k):
        out = []
        for i, rows in enumerate(batches):  # each run is a restart from the checkpoint
            spark.createDataFrame(rows, store.REQUEST).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(store.REQUEST).parquet(str(tmp_path / "in"))
            with store.state_in_files(spark):
                served = store.serve(stream, "60 seconds", **k).writeStream.foreachBatch(lambda df, n: out.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp"))
                served.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return out

    return go


def test_put_get_expiry_late_rows_over_batches_and_restarts(run):
    found = [(r.key, r.op, int((r.at - T0).total_seconds()), r.outcome, r.value, r.hits) for r in run(BATCHES)]
    assert sorted(x for x in found if x[0] == "a" and x[1] != "end") == sorted([
        ("a", "put", 0, "stored", None, 0), ("a", "get", 10, "hit", "Alpha one", 1), ("a", "get", 10, "hit", "Alpha one", 2), ("a", "get", 11, "no_match", None, 2), ("a", "get", 12, "stale", None, 2),
        ("a", "put", 80, "stored", None, 2), ("a", "put", 90, "stored", None, 2), ("a", "get", 99, "hit", "Alpha two", 3), ("a", "get", 189, "hit", "Alpha two", 4), ("a", "get", 190, "expired", None, 4),
    ])  # the get at second 1 of the last batch is later than the watermark: dropped
    assert ("b", "get", 10, "missing", None, 0) in found and ("c", "get", 5, "expired", None, 0) in found
    assert {x for x in found if x[0] == "n" and x[1] == "get"} == {("n", "get", 160, "no_match", None, 0), ("n", "get", 160, "hit", None, 1)}
    ended = [x for x in found if x[1] == "end"]
    assert {x[0] for x in ended} == {"a", "c", "n"} and all(x[3] == "forgotten" for x in ended)
    assert ("c", "get", 4000, "missing", None, 0) in found  # its state is gone


def test_entries_are_remembered_past_their_end(run):
    found = run([[put("c", 0, "short", keep=5)], [put("z", 500, "x")], [get("c", 600)]], remember=10_000)
    assert [r.outcome for r in found if r.key == "c" and r.op == "get"] == ["expired"]


def test_a_table_is_answered_as_a_stream(spark, run):
    rows = [x for b in BATCHES[:1] for x in b] + [put("a", 13, "Alpha three", version="v2"), get("a", 14, version="v2"), get("a", 112, version="v2"), get("a", 113, version="v2")]
    told = lambda found: sorted(((r.key, r.op, r.at, r.outcome, r.value, r.hits, r.ends) for r in found if r.op != "end"), key=repr)
    assert told(run([rows])) == told(store.answers(spark.createDataFrame(rows, store.REQUEST)).collect())
