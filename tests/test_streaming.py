from datetime import datetime

import pytest

from lexquarry.streaming import events as ev

ROWS = [("a", 1, datetime(2024, 1, 1, 0, 0, 5)), ("a", 2, datetime(2024, 1, 1, 0, 0, 50)), ("b", 1, datetime(2024, 1, 1, 0, 1, 0)), ("a", 3, datetime(2024, 1, 1, 2, 0, 0)), ("b", 1, datetime(2024, 1, 1, 0, 1, 0))]


@pytest.fixture
def stream(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, "key string, seq long, ts timestamp")
    for i in range(2):
        rows.where(f"pmod(seq, 2) = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_fold_keeps_the_latest_row(spark, stream, tmp_path):
    state = str(tmp_path / "state")
    ev.fold_log(stream, state, "key", "seq", checkpoint=str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.key, r.seq) for r in ev.read_state(spark, state).collect()) == [("a", 3), ("b", 1)]
    # a new checkpoint goes on from the state, and a log of one later row keeps the rest
    later = spark.createDataFrame([("c", 9, ROWS[0][2])], "key string, seq long, ts timestamp")
    later.coalesce(1).write.parquet(str(tmp_path / "more"))
    ev.fold_log(spark.readStream.schema(later.schema).parquet(str(tmp_path / "more")), state, "key", "seq", checkpoint=str(tmp_path / "cp2")).awaitTermination()
    assert sorted((r.key, r.seq) for r in ev.read_state(spark, state).collect()) == [("a", 3), ("b", 1), ("c", 9)]


def _memory(spark, df, name, tmp_path, mode):
    df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_rates_of_a_stream_are_those_of_the_table(spark, stream, tmp_path):
    got = _memory(spark, ev.rate_per_minute(stream, "key", 1), "rates", tmp_path, "complete")
    table = spark.createDataFrame(ROWS, "key string, seq long, ts timestamp")
    want = ev.rate_per_minute(table, "key", 1).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and any(r.limited for r in got)


def test_sessions_and_repeats(spark, stream, tmp_path):
    table = spark.createDataFrame(ROWS, "key string, seq long, ts timestamp")
    assert sorted((r.key, r.n) for r in ev.sessions(table, "key").collect()) == [("a", 1), ("a", 2), ("b", 2)]
    got = _memory(spark, ev.distinct_events(stream.selectExpr("concat(key, seq) AS id", "ts"), "id", late="5 hours"), "repeats", tmp_path, "append")
    assert sorted(r.id for r in got) == ["a1", "a2", "a3", "b1"]


def _sizes(folder):
    return {str(p.relative_to(folder)): p.stat().st_size for p in folder.rglob("*.parquet")}


def test_fold_writes_only_the_buckets_of_a_batch(spark, tmp_path):
    schema = "key string, seq long, note string"
    first = [(f"k{i}", 0, "x" * 50) for i in range(4000)]
    batches = [first, [("k7", 1, "new"), ("k7", 3, "newest"), ("k9", 1, "n")], [("k7", 2, "older"), ("fresh", 0, "f"), (None, 5, "null key")]]
    state, source = str(tmp_path / "state"), str(tmp_path / "in")
    written, held = [], {}
    for rows in batches:  # each run goes on from the checkpoint, as after a restart
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ev.fold_log(spark.readStream.schema(schema).parquet(source), state, "key", "seq", checkpoint=str(tmp_path / "cp"), buckets=16).awaitTermination()
        now = _sizes(tmp_path / "state")
        written.append(sum(n for f, n in now.items() if f not in held))
        held = now
    got = {r.key: r.seq for r in ev.read_state(spark, state).collect()}
    assert got == {**{f"k{i}": 0 for i in range(4000)}, "k7": 3, "k9": 1, "fresh": 0, None: 5}
    assert written[1] < written[0] * 4 / 16 and written[2] < written[0] * 5 / 16


def test_a_batch_that_was_applied_is_not_applied_again(spark, stream, tmp_path):
    from lexquarry.sources.published import current

    state = str(tmp_path / "state")
    ev.fold_log(stream, state, "key", "seq", checkpoint=str(tmp_path / "cp")).awaitTermination()
    before = current(spark, state).number
    for f in (tmp_path / "cp" / "commits").iterdir():  # as if the query had been lost before it could note its last batch
        if f.name.lstrip(".").startswith("1"):
            f.unlink()
    ev.fold_log(stream, state, "key", "seq", checkpoint=str(tmp_path / "cp")).awaitTermination()
    assert current(spark, state).number == before
    assert sorted((r.key, r.seq) for r in ev.read_state(spark, state).collect()) == [("a", 3), ("b", 1)]
