import random
from datetime import datetime, timedelta

import pytest

from lexquarry.operators import joins

T0 = datetime(2024, 1, 1)


def _at(s):
    return None if s is None else T0 + timedelta(seconds=s)


def test_as_of_equals_brute_force_with_one_key_in_half_of_all_rows(spark):
    rng = random.Random(7)
    key = lambda: rng.choice([1, 1, 1, 1, None, *range(2, 8)])
    left = [(i, key(), rng.choice([None, *range(400)]), "x") for i in range(1500)]
    right = [(key(), rng.choice([None, *range(0, 400, 3)]), rng.choice([None, *range(50)])) for _ in range(1200)]
    df = spark.createDataFrame([(i, k, _at(s), x) for i, k, s, x in left], "id long, k long, at timestamp, note string").repartition(4)
    known = spark.createDataFrame([(k, _at(s), v) for k, s, v in right], "k long, at timestamp, v long").repartition(3)
    got = {r.id: r.v for r in joins.as_of(df, known, "k", "at", "v").collect()}
    for i, k, s, _ in left:
        rows = [(t, v is not None, v or 0, v) for kk, t, v in right if k is not None and s is not None and kk == k and t is not None and t <= s]
        assert got[i] == (max(rows)[3] if rows else None), (i, k, s)
    assert len(got) == len(left)


def test_as_of_null_keys_and_null_values(spark):
    left = spark.createDataFrame([(1, None, _at(9)), (2, "a", _at(9)), (3, "a", None), (4, "b", _at(0))], "id long, k string, at timestamp")
    right = spark.createDataFrame([(None, _at(1), 5), ("a", _at(1), 6), ("a", _at(2), None), ("b", _at(0), 7)], "k string, at timestamp, v long")
    assert {r.id: r.v for r in joins.as_of(left, right, "k", "at", "v").collect()} == {1: None, 2: None, 3: None, 4: 7}
    assert joins.as_of(left.limit(0), right, "k", "at", "v").count() == 0
    assert {r.v for r in joins.as_of(left, right.limit(0), "k", "at", "v").collect()} == {None}


@pytest.mark.parametrize("width", [10, 86_400])
def test_overlaps_equal_brute_force(spark, width):
    rng = random.Random(1)
    make = lambda n: [(rng.choice([1, 1, 2, None]), i, s, rng.choice([None, s, (s or 0) + rng.randrange(60)])) for i in range(n) for s in [rng.choice([None, *range(200)])]]
    a, b = make(150), make(120)
    frame = lambda rows: spark.createDataFrame([(k, i, _at(s), _at(e)) for k, i, s, e in rows], "k long, id long, a timestamp, b timestamp")
    got = sorted((r.id, r.id_right) for r in joins.overlaps(frame(a), frame(b), ["k"], "a", "b", width).collect())
    real = lambda r: r[0] is not None and r[2] is not None and r[3] is not None and r[2] < r[3]
    assert got == sorted((x[1], y[1]) for x in a for y in b if real(x) and real(y) and x[0] == y[0] and x[2] < y[3] and y[2] < x[3]) and got
