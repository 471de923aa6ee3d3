import math

import numpy as np
from pyspark.sql import functions as F

from lexquarry.llm import hard_negatives as hn
from lexquarry.llm.registry import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, v string, key string, cell string, place string"


def brute(rows, every=100):
    """By plain sorted lists of Python's whole numbers."""
    held = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        held.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    dot = lambda a, b: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False))))
    out = []
    for at, (i, label, v) in enumerate(held):
        if i is None or i % every:
            continue
        listed = sorted(((-dot(v, w), j is None, j or 0, j, other, k) for k, (j, other, w) in enumerate(held)), key=lambda x: x[:3])
        for s, _, _, j, other, k in [x for x in listed if x[4] == label and x[5] != at][:5]:
            found = [x for x in listed if x[4] != label and -80 * s <= -100 * x[0] <= -100 * s][:5]
            out += [(i, j, r + 1, x[3], -s, -x[0]) for r, x in enumerate(found)]
    return sorted(out, key=repr)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in hard_negatives(df).collect()), key=repr)


def _rows(n, width=6, seed=3):
    rng = np.random.default_rng(seed)
    near = rng.normal(size=width)
    return [(int(i), [float(np.float32(x)) for x in near + rng.normal(size=width) * (0.05 + (i % 5) / 4)], int(rng.integers(0, 4))) for i in range(n)]


def test_equals_brute_force_with_ties_repeats_and_nulls(spark):
    rows = _rows(420)
    rows += [(100, rows[7][1], 1), (100, rows[7][1], 1), (300, rows[9][1], 2), (5, rows[0][1], 3)]  # repeated ids and vectors
    rows += [(None, rows[100][1], 1), (None, rows[3][1], 2), (500, None, 1), (600, [1.0, None], 1), (700, [float("nan")] * 6, 1), (800, [float("inf")] * 6, 2), (900, rows[1][1], None)]
    rows += [(1000, [], 1), (1001, [0.5], 1), (1100, rows[2][1] + [3.0, -2.0], 2)]  # other lengths
    rows += [(2000 + i, [0.25] * 6, i % 3) for i in range(80)]  # one vector many times
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 50
    assert len({r[0] for r in got}) > 3


def test_blocks_and_runs_do_not_change_the_result(spark, monkeypatch):
    rows = _rows(700, seed=9)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 2)
    monkeypatch.setattr(hn, "RUN_ROWS", 100)
    monkeypatch.setattr(hn, "LEAST_RUNS", 3)
    monkeypatch.setattr(hn, "_TILE", 150)
    assert mined(spark, rows) == brute(rows)


def test_negative_scores_and_one_label(spark):
    rows = [(i, [1.0 if i % 100 == 0 else -1.0 - i / 64, 0.5], i % 2) for i in range(150)]
    assert mined(spark, rows) == brute(rows)
    alone = [(i, [1.0, 2.0], 1) for i in (100, 101, 102)]
    assert mined(spark, alone) == []


def test_large_numbers(spark):
    big = [(100, [3e30, 1.0], 1), (1, [2e30, 1.0], 1), (2, [2.5e30, 0.0], 2), (3, [1e9, 1e9], 2), (200, [4e7, 3e7], 4), (201, [5e7, 1.0], 4), (204, [4.5e7, 1.5], 5), (300, [3e11, 4e11], 6), (303, [2e11, 1.0], 6), (302, [1.9e11, 1.0], 8)]
    held = [(i, [max(-(2**63), min(2**63 - 1, math.floor(256 * float(np.float32(x))))) for x in v], label) for i, v, label in big]
    got = mined(spark, big)
    assert {r[0] for r in got} == {100, 200, 300}
    for anchor, positive, _, negative, s, t in got:
        v = {i: x for i, x, _ in held}
        clip = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
        assert s == clip(sum(x * y for x, y in zip(v[anchor], v[positive], strict=True))) and t == clip(sum(x * y for x, y in zip(v[anchor], v[negative], strict=True)))


def test_empty_table(spark):
    assert mined(spark, []) == []
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hn.mine(none.withColumn("q", hn.quantised("embedding")), F.col("vec_id") % 100 == 0, vector="q").count() == 0
