"""Stored summaries against exact values; days that come new, again and late."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.operators import summaries

DAY = dt.date(2024, 3, 1)


def _rows(spark, days, n=4000, seed=1):
    draw = np.random.default_rng(seed)
    data = [(DAY + dt.timedelta(days=d), "ab"[i % 2], int(x), float(v)) for d in days for i, (x, v) in enumerate(zip(draw.zipf(1.4, n) % 100_000, draw.exponential(50, n), strict=True))]
    return spark.createDataFrame(data, "day date, kind string, item long, v double")


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "state")


def _add(df, folder, **more):
    summaries.add_days(df, folder, "day", ["kind"], "item", "v", **more)


def test_merged_days_are_within_the_bounds(spark, folder):
    rows = _rows(spark, range(5))
    _add(rows, folder)
    got = {r.kind: r for r in summaries.estimates(summaries.merged(summaries.stored(spark, folder), ["kind"]), (0.1, 0.5, 0.99), 5).collect()}
    for kind in "ab":
        own = [(r.item, r.v) for r in rows.where(F.col("kind") == kind).collect()]
        values, r = np.sort([v for _, v in own]), got[kind]
        items, counts = np.unique([x for x, _ in own], return_counts=True)
        assert (r.n, r.n_values, r.least, r.most) == (len(own), len(own), values[0], values[-1]) and r.total == pytest.approx(values.sum())
        assert abs(r.n_items - len(items)) <= 4 * 0.013 * len(items)
        for q, v in zip((0.1, 0.5, 0.99), r.quantiles, strict=True):
            assert abs(np.searchsorted(values, v) / len(values) - q) <= 0.025
        best = dict(zip(items[np.argsort(-counts)][:5].tolist(), np.sort(counts)[::-1][:5].tolist(), strict=True))
        assert {c["item"]: c["count"] for c in r.counts} == best


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_a_new_day_touches_no_other(spark, folder):
    _add(_rows(spark, [0, 1], 100), folder)
    before = _files(folder)
    _add(_rows(spark, [2], 100), folder)
    after = _files(folder)
    assert before.items() <= after.items() and all("day=2024-03-03" in f for f in after.keys() - before.keys())
    n = lambda: summaries.merged(summaries.stored(spark, folder)).first().n
    assert n() == 300
    _add(_rows(spark, [2], 100), folder)  # sent again
    assert n() == 300
    _add(_rows(spark, [1, 3], 50, 2), folder, late=True)
    assert n() == 400 and {f: t for f, t in _files(folder).items() if "day=2024-03-01" in f}.items() <= before.items()


def test_nulls_and_nothing(spark, folder):
    assert summaries.stored(spark, folder) is None
    df = spark.createDataFrame([(DAY, None, None, None), (DAY, None, 3, float("nan")), (DAY, "a", 3, 1.0)], "day date, kind string, item long, v double")
    _add(df, folder, late=True)
    got = {r.kind: r for r in summaries.estimates(summaries.merged(summaries.stored(spark, folder), ["kind"])).collect()}
    assert (got[None].n, got[None].n_values, got[None].n_items, got[None].quantiles) == (2, 0, 1, None)
    assert (got["a"].n, got["a"].n_values, got["a"].quantiles) == (1, 1, [1.0])
    assert summaries.merged(summaries.stored(spark, folder).where("n < 0")).count() == 0
    with pytest.raises(ValueError):
        _add(df.withColumn("day", F.lit(None).cast("date")), folder)
