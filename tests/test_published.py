import time

import pytest
from pyspark.sql import functions as F

from lexquarry.sources import published as pb


def _t(spark, rows, **k):
    return pb.Table(spark.createDataFrame(rows, "k long, v string"), **k)


def _rows(version, name):
    return sorted(((r.k, r.v) for r in version.table(name).collect()), key=repr)


def test_tables_change_together_and_are_carried_on(spark, tmp_path):
    folder = str(tmp_path / "index")
    assert pb.current(spark, folder).number == 0
    pb.publish(spark, folder, {"a": _t(spark, [(1, "x")]), "b": _t(spark, [(1, "y")])})
    pb.publish(spark, folder, {"a": _t(spark, [(2, "z")])})
    now = pb.current(spark, folder)
    assert (now.number, _rows(now, "a"), _rows(now, "b")) == (2, [(2, "z")], [(1, "y")])
    pb.publish(spark, folder, {"b": _t(spark, [(3, "w")])}, carry=False)
    assert list(pb.current(spark, folder).tables) == ["b"]


def test_failure_between_two_tables_leaves_the_old_ones(spark, tmp_path):
    folder = str(tmp_path / "index")
    pb.publish(spark, folder, {"a": _t(spark, [(1, "old")]), "b": _t(spark, [(1, "old")])})
    bad = pb.Table(spark.range(5).select(F.col("id").alias("k"), F.raise_error(F.lit("broken")).cast("string").alias("v")))
    with pytest.raises(Exception, match="broken"):
        pb.publish(spark, folder, {"a": _t(spark, [(2, "new")]), "b": bad})
    now = pb.current(spark, folder)
    assert now.number == 1 and _rows(now, "a") == _rows(now, "b") == [(1, "old")]
    half = [p for p in (tmp_path / "index" / "versions").iterdir() if p.name.startswith("00000002")]
    assert half and (half[0] / "a").is_dir()
    pb.sweep(spark, folder, grace=3600)
    assert half[0].is_dir()  # it may still be being written
    pb.sweep(spark, folder, grace=0, now=time.time() + 10)
    assert not half[0].exists() and _rows(pb.current(spark, folder), "b") == [(1, "old")]


def test_a_reader_open_across_publications_sees_one_version(spark, tmp_path):
    folder = str(tmp_path / "index")
    pb.publish(spark, folder, {"a": _t(spark, [(1, "one")]), "b": _t(spark, [(1, "one")])})
    reader = pb.current(spark, folder)
    a = reader.table("a")
    pb.publish(spark, folder, {"a": _t(spark, [(1, "two")]), "b": _t(spark, [(1, "two")])})
    pb.sweep(spark, folder, grace=3600)
    assert [r.v for r in a.collect()] == ["one"] and _rows(reader, "b") == [(1, "one")]
    pb.publish(spark, folder, {"a": _t(spark, [(1, "three")])})
    gone = pb.sweep(spark, folder, grace=0, now=time.time() + 10)
    now = pb.current(spark, folder)
    assert len(gone) == 3 and (_rows(now, "a"), _rows(now, "b")) == ([(1, "three")], [(1, "two")])  # b of version 2 is carried on


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    folder = str(tmp_path / "index")
    first = pb.publish(spark, folder, {"a": _t(spark, [(1, "x")])})
    pb.publish(spark, folder, {"a": _t(spark, [(2, "y")])}, after=first)
    with pytest.raises(pb.Conflict):
        pb.publish(spark, folder, {"a": _t(spark, [(3, "z")])}, after=first)

    class Late(pb.Table):
        def first_of_keys(self):
            pb.publish(spark, folder, {"a": _t(spark, [(4, "between")])})
            return super().first_of_keys()

    with pytest.raises(pb.Conflict):
        pb.publish(spark, folder, {"a": Late(_t(spark, [(5, "late")]).rows)})
    assert _rows(pb.current(spark, folder), "a") == [(4, "between")]


def test_the_first_row_of_a_key_stays(spark, tmp_path):
    rows = [(1, "b"), (1, "a"), (None, "d"), (None, "c"), (2, None)]
    got = pb.publish(spark, str(tmp_path / "i"), {"t": _t(spark, rows, keys=("k",), order=("v",))})
    assert _rows(got, "t") == [(1, "a"), (2, None), (None, "c")]
    assert pb.publish(spark, str(tmp_path / "j"), {"t": _t(spark, [])}).table("t").count() == 0
