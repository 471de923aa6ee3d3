import hashlib
import random
import re

import pytest

from lexquarry.llm import fill_middle as fm


def brute(key, text):
    """By a list of all units."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    assert "".join(units) == text
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return (key, n, "plain", None, None, text)
    if h[3] % 100 < 80:
        return (key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.fixture(scope="module")
def rows(corpus):
    rng = random.Random(5)
    stock = ["<", "<S", "S>", "P>", "<M", ">", "é", "日本", " ", "\n", "\t", " ", " ", "\x0b", "w", "\x00"]
    odd = [(1000 + i, "".join(rng.choice(stock) for _ in range(rng.randrange(0, 25)))) for i in range(400)]
    marked = [(2000 + i, f"a {m} b") for i, m in enumerate(("<P>", "<S>", "<M>"))]
    return [(c[0], c[1]) for c in corpus] + odd + marked + [(3000, " x" * 600_000), (3001, "y" * 2_500_000), (None, None), (-7, "minus seven words here are five")]


def test_equals_brute_force_and_restores(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, output string, form string").repartition(3)
    out = fm.fill_in_middle(df)
    order = lambda found: sorted(found, key=repr)
    assert order(tuple(r) for r in out.collect()) == order(brute(*r) for r in rows)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = order((*brute(*r)[:5], sha(brute(*r)[5]), sha(r[1] or "")) for r in rows)
    assert order(tuple(r) for r in fm.digests(out).collect()) == want
    assert {r[2] for r in want} == {"plain", "spm", "psm"}


def test_empty_table_other_names_and_settings(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert fm.digests(fm.fill_in_middle(none)).count() == 0
    df = spark.createDataFrame([(i, "a b c") for i in range(50)], "k int, body string")
    got = fm.fill_in_middle(df, "body", "k", fm.Draw(transformed=100, suffix_first=0))
    assert {r.form for r in got.collect()} == {"psm"}
    assert {r.t for r in got.select(fm.restored("output", "form").alias("t")).collect()} == {"a b c"}


def test_cuts_move_one_iterator():
    text = "one  two\tthree "
    assert [fm.cut_points(text, a, b) for a, b in ((0, 0), (0, 1), (1, 1), (1, 3), (2, 4), (4, 4))] == [(0, 0), (0, 3), (3, 3), (3, 14), (8, 15), (15, 15)]
    assert fm.count_units(text) == 4
