"""Every query with an oracle gives the rows of its SQL."""

import math
import os

import duckdb
import pytest

from lexquarry.plans.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def _plain(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in got.collect()]
    if name not in ORACLES:
        assert rows
        return
    want = duck.sql(ORACLES[name])
    a, b = _sorted(got.columns, rows), _sorted(want.columns, want.fetchall())
    assert a[0] == b[0]
    assert len(a[1]) == len(b[1])
    wrong = [(x, y) for x, y in zip(a[1], b[1], strict=True) if x != y]
    assert not wrong, wrong[:3]
