import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from lexquarry.sources import records

SCHEMA = StructType().add("id", StringType()).add("n", LongType())


def _write(path, lines):
    path.write_text("\n".join(lines))
    return str(path)


def test_strict_read_fails_on_a_bad_line(spark, tmp_path):
    good = _write(tmp_path / "a.jsonl", ['{"id": "x", "n": 1}', '{"id": "y", "n": null}'])
    assert records.read_jsonl(spark, good, SCHEMA).count() == 2
    bad = _write(tmp_path / "b.jsonl", ['{"id": "x", "n": 1}', "{oops"])
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        records.read_jsonl(spark, bad, SCHEMA).collect()


def test_tolerant_read_and_report(spark, tmp_path):
    _write(tmp_path / "a.jsonl", ['{"id": "x", "n": 1}', "{oops", "", '{"n": 2}'])
    good, bad = records.read_jsonl_tolerant(spark, str(tmp_path / "a.jsonl"), SCHEMA)
    assert sorted((r.id or "", r.n) for r in good.collect()) == [("", 2), ("x", 1)]
    assert [r.value for r in bad.collect()] == ["{oops"]
    row = records.line_report(spark, str(tmp_path)).first()
    assert (row.rows, row.with_id, row.invalid) == (3, 1, 1)


@pytest.mark.parametrize("name,content", [
    ("s.csv", "Rule ID,Effective\n r1 ,2020-01-01\n,2021-01-01\n"),
    ("s.jsonl", '{"rule": "r1", "Effective": "2020-01-01"}\n{"rule": null, "Effective": "2021-01-01"}'),
    ("s.json", json.dumps({"records": [{"rule": "r1", "eff": "2020-01-01"}, {"rule": "", "eff": "2021-01-01"}]})),
])
def test_snapshots_have_canonical_names(spark, tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    got = records.read_snapshot(spark, str(path), {"rule_id": ["Rule ID", "rule"], "effective": ["Effective", "eff"], "none": ["absent"]})
    assert sorted((r.rule_id or "", r.effective, r.none) for r in got.collect()) == [("", "2021-01-01", None), ("r1", "2020-01-01", None)]


def test_markdown(spark, tmp_path):
    (tmp_path / "a.md").write_text('---\ntitle: "A: b"\nid: x1\n---\n# Heading one\n\nBody\n')
    row = records.read_markdown(spark, str(tmp_path / "a.md")).first()
    assert row.frontmatter == {"title": "A: b", "id": "x1"} and row.heading == "Heading one" and row.body.startswith("# Heading")


def test_upsert_and_partitioned_sink(spark, tmp_path):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, n long")
    got = records.upsert(a, spark.createDataFrame([("y", 5), ("z", 6)], "id string, n long"), ["id"])
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 5), ("z", 6)]
    dated = got.withColumn("day", F.lit("2020-05-01").cast("date"))
    records.write_by_quarter(dated, str(tmp_path / "out"), "day")
    assert (tmp_path / "out" / "year=2020" / "quarter=2").is_dir()


def test_optional_and_numbered_scans(spark, tmp_path):
    schema = StructType().add("id", "string").add("n", "long")
    assert records.read_jsonl_optional(spark, str(tmp_path / "none.jsonl"), schema).count() == 0
    (tmp_path / "m.jsonl").write_text('{"id": "a", "n": 1}\n\nbroken\n{"id": "b", "n": 2}\n')
    rows = records.read_manifest(spark, str(tmp_path / "m.jsonl"), schema).orderBy("line").collect()
    assert [(r.line, r.row and r.row.id, bool(r.error)) for r in rows] == [(1, "a", False), (3, None, True), (4, "b", False)]
    (tmp_path / "ok.jsonl").write_text('{"id": "a", "n": 1}\n\n{"id": "c", "n": 3}\n')
    layers = records.read_layers(spark, {"x": str(tmp_path / "ok.jsonl"), "y": str(tmp_path / "gone.jsonl")}, schema)
    assert sorted((r.id, r.layer) for r in layers.collect()) == [("a", "x"), ("c", "x")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1, 2]), ('b"q', None), (None, [])], "id string, l array<long>")
    records.write_csv(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).collect()
    assert sorted((r.id or "", r.l or "") for r in back) == [("", "[]"), ("a", "[1,2]"), ('b"q', "")]
    old = records.write_snapshot(rows, str(tmp_path / "snap"), "1")
    records.write_snapshot(rows.limit(1), str(tmp_path / "snap"), "2")
    assert spark.read.json(old).count() == 3
    path = str(tmp_path / "log")
    for k in range(2):
        records.append_jsonl(spark.createDataFrame([(f"r{k}",)], "id string"), path, "id string")
    assert spark.read.json(path).count() == 2
    records.write_object(spark.createDataFrame([(1, ["a"])], "n long, l array<string>"), str(tmp_path / "object"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "object"), wholetext=True).collect())
    assert json.loads(text) == {"n": 1, "l": ["a"]} and text.count("\n") >= 3
    made = records.replace_index({"t": (spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k long, v string"), ["k"])}, str(tmp_path / "index"))
    assert made.table("t").count() == 2


def test_upsert_takes_the_last_of_repeated_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v long")
    rows = spark.createDataFrame([("a", 10), ("a", 11), (None, 20), ("d", 30)], "k string, v long")
    got = records.upsert(target, rows, ["k"], "v").collect()
    assert sorted((r.k or "", r.v) for r in got) == [("", 20), ("a", 11), ("c", 3), ("d", 30)]
