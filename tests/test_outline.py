import random
import re

import pytest
from pyspark.sql import functions as F

from lexquarry.functions import outline as ol

MD = ol.Shape((("h1", "^# (.*)"), ("h2", "^## (.*)"), ("h3", "^### (.*)")))


def rows(spark, texts, shape):
    df = spark.createDataFrame([(i, t, "c", "c") for i, t in enumerate(texts)], "id long, x string, body string, block string").repartition(2)
    return [r.asDict() for r in ol.outline(df, "id", "x", shape).orderBy("id", "block", "piece").collect()]


def test_headings_stack_and_close(spark):
    got = rows(spark, ["above\n# A\none\ntwo\n## B\n### C\ndeep\n# D\n## E\nlast"], MD)
    assert [(r["block"], r["level"], r["path"], r["body"], r["n_lines"], r["opened_line"], r["first_line"], r["last_line"]) for r in got] == [
        (0, 0, [], "above", 1, None, 1, 1), (1, 1, ["A"], "one\ntwo", 2, 2, 3, 4), (2, 2, ["A", "B"], "", 0, 5, 5, 5), (3, 3, ["A", "B", "C"], "deep", 1, 6, 7, 7), (4, 1, ["D"], "", 0, 8, 8, 8), (5, 2, ["D", "E"], "last", 1, 9, 10, 10),
    ]
    assert got[3]["labels"] == {"h1": "A", "h2": "B", "h3": "C"} and (got[1]["first_char"], got[1]["last_char"]) == (11, 17)


def test_a_skipped_level_and_null_and_empty(spark):
    got = rows(spark, ["### only\nx", None, "", "# é\n日本"], MD)
    assert [(r["id"], r["path"], r["body"], r["first_char"], r["last_char"]) for r in got] == [(0, ["only"], "x", 10, 10), (1, [], "", 1, 0), (2, [], "", 1, 0), (3, ["é"], "日本", 5, 6)]
    assert rows(spark, [], MD) == []


def test_noise_pages_and_pieces(spark):
    shape = ol.Shape((("s", r"^Section (\d+)"),), noise=r"^\d+$", marker=r"^\[\[page (\d+)", most=20, blank=True, joint=" ")
    got = rows(spark, ["[[page 1]]\nSection 1 x\nalpha beta\ngamma\n7\ndelta delta\n[[page 2]]\nmore and more\n\nend\nSection 2\n[[page 4]]\nlast"], shape)
    assert [(r["block"], r["piece"], r["heading"], r["body"], r["first_page"], r["last_page"], r["first_line"], r["last_line"]) for r in got] == [
        (1, 0, "1", "alpha beta gamma", 1, 1, 3, 4), (1, 1, "1", "delta delta", 1, 1, 6, 6), (1, 2, "1", "more and more", 2, 2, 8, 8), (1, 3, "1", "end", 2, 2, 10, 10), (2, 0, "2", "last", 4, 4, 13, 13),
    ]


def test_long_titles_many_headings_and_long_texts(spark):
    title = "T" * 300
    many = "\n".join(f"# {title}{i}\nline {i}" for i in range(12_000))
    got = rows(spark, [many, "x\n" * 300_000], MD)
    assert sum(r["id"] == 0 for r in got) == 12_000 and got[11_999]["heading"] == f"{title}11999" and got[11_999]["body"] == "line 11999"
    assert got[-1]["n_lines"] == 300_001 and got[-1]["last_line"] == 300_001


@pytest.mark.parametrize("seed", range(3))
def test_lines_are_where_they_are_said_to_be(spark, seed):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choice(["# a", "## b", "### c", "text", "", "é more", "## "]) for _ in range(rng.randrange(0, 30))) for _ in range(40)]
    found = rows(spark, texts, MD)
    for i, text in enumerate(texts):
        own = [r for r in found if r["id"] == i]
        lines = text.split("\n")
        kept = [x for x in lines if not re.match("^#{1,3} ", x)]
        assert [x for r in own if r["n_lines"] for x in r["body"].split("\n")] == kept
        for r in own:
            if r["n_lines"]:
                assert lines[r["first_line"] - 1 : r["last_line"]] == r["body"].split("\n") and text[r["first_char"] - 1 : r["last_char"]] == r["body"]


def test_no_shuffle(spark):
    df = spark.range(10).select("id", F.lit("# a\nb").alias("x"))
    assert "Exchange" not in ol.outline(df, "id", "x", MD)._jdf.queryExecution().executedPlan().toString()
