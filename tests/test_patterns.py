import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.functions import text
from lexquarry.operators import joins, patterns


def brute(rows, terms):
    out = []
    for key, body in rows:
        for number, term, whole in terms:
            if not term or body is None:
                continue
            hits = [m.start() for m in re.finditer(f"(?={re.escape(term)})", body)]
            if whole:
                word = lambda c: c.isalnum() and c.isascii() or c == "_" or ord(c) > 127
                hits = [h for h in hits if not (h and word(body[h - 1])) and not (h + len(term) < len(body) and word(body[h + len(term)]))]
            if hits:
                out.append((key, number, len(hits), hits[0] + 1))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(6)
    stock = ["water", "law", "waterlaw", "x", "é", "éa", "aa", "aaaa", "日本", "b_c", "she", "he", "hers", "his", " ", "-", ".", "\n"]
    rows = [(i, "".join(rng.choice(stock) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "water " * 3000 + "needle in it"), (203, "a" * 5000), (3, "law again law"), (None, "he")]
    terms = [(1, "water", True), (2, "water", False), (3, "he", True), (4, "he", False), (5, "hers", False), (6, "she", True), (7, "aa", False), (8, "aaaa", False), (9, "é", True), (10, "日本", False)]
    terms += [(11, "", True), (12, None, True), (13, "water law", True), (14, "needle in", True), (15, "b_c", True), (16, "_", False), (17, "w" * 300, True), (18, "a" * 40, False), (19, "water", None)]
    return rows, terms


def _match(spark, rows, terms, limit):
    df = spark.createDataFrame(rows, "id long, body string").repartition(3)
    known = spark.createDataFrame(terms, "term_id long, term string, whole boolean")
    return sorted((tuple(r) for r in patterns.match_terms(df, "id", "body", known, limit).collect()), key=repr)


@pytest.mark.parametrize("limit", [patterns.AUTOMATON_BYTES, 0])
@pytest.mark.parametrize("lane", [16, 512])
def test_both_ways_equal_brute_force(spark, data, monkeypatch, limit, lane):
    monkeypatch.setattr(patterns, "LANE", lane)
    rows, terms = data
    want = brute(rows, [(a, b, c is not False) for a, b, c in terms])
    assert _match(spark, rows, terms, limit) == want and len(want) > 300


@pytest.mark.parametrize("limit", [patterns.AUTOMATON_BYTES, 0])
def test_empty_tables(spark, limit):
    assert _match(spark, [], [(1, "a", True)], limit) == []
    assert _match(spark, [(1, "a")], [], limit) == []
    assert _match(spark, [(1, "ab"), (2, "")], [(1, "zzz", True)], limit) == []


def test_ten_thousand_terms_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", text.normalize("text").alias("norm"))
    words = docs.select(F.explode(F.split("norm", " ")).alias("term")).where(F.length("term") >= 2).distinct().orderBy(F.xxhash64("term")).limit(10_000)
    terms = words.withColumn("term_id", F.xxhash64("term")).cache()
    n_terms = terms.count()
    assert n_terms > 5000
    got = patterns.match_terms(docs, "doc_id", "norm", terms)
    again = patterns.match_terms(docs, "doc_id", "norm", terms, limit=0)
    whole = docs.select("doc_id", F.explode(F.split("norm", " ")).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("n")).join(terms, "term").select(F.col("doc_id").alias("key"), "term_id", "n")
    a, b, c = ({tuple(r) for r in x.select("key", "term_id", "n").collect()} for x in (got, again, whole))
    assert a == b == c and len(a) > 10_000


def test_half_of_all_rows_hold_one_triple(spark):
    rows = [(i, "common words here" if i % 2 else f"rare{i} one") for i in range(3000)]
    assert _match(spark, rows, [(1, "common", True), (2, "rare8", False), (3, "here", True)], 0) == brute(rows, [(1, "common", True), (2, "rare8", False), (3, "here", True)])


def test_tags_are_those_of_rules_as_literals(spark, data):
    rules = {"wet": (("water", "law"), 0.9), "people": (("he", "she", "his"), 0.5)}
    df = spark.createDataFrame(data[0][:120], "id long, body string").select("id", text.normalize("body").alias("norm"))
    want = joins.keyword_rules(df, "id", F.col("norm"), rules)
    flat = [(10 * k + j, t, tag, w) for k, (tag, (terms, w)) in enumerate(rules.items()) for j, t in enumerate(terms)]
    table = spark.createDataFrame(flat, "term_id long, term string, tag string, weight double")
    got = patterns.tagged(patterns.match_terms(df, "id", "norm", table), table.select("term_id", "tag", "weight"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_speed_does_not_go_by_the_number_of_terms():
    import time

    rng = np.random.default_rng(1)
    raw = rng.integers(97, 105, 4_000_000).astype(np.uint8)
    offsets = np.arange(0, 4_000_001, 4000)
    took = []
    for n in (10, 5000):
        auto = patterns.build([(i, bytes(rng.integers(97, 105, 12).astype(np.uint8)), False) for i in range(n)])
        began = time.process_time()
        patterns.occurrences(auto, raw, offsets)
        took.append(time.process_time() - began)
    assert took[1] < 15 * took[0] + 1


def test_joined_terms_send_only_what_matches(spark):
    """Terms that share their rarest triple do not meet every text, and no text is shuffled; long terms and equal ones are found."""
    import random

    rng = random.Random(2)
    long = "é" * 40 + " tail " + "x" * 30
    terms = [(i, f"the{i:04d}", True) for i in range(500)] + [(900, "the", False), (901, "the", False), (902, long, True), (903, long[:39], False), (904, "a", True), (905, "z.", False)]
    texts = [(i, " ".join(rng.choice(["the0007", "the", "other", "thethe", "a", "z.", long, "the0499x", "é"]) for _ in range(rng.randrange(0, 40)))) for i in range(200)]
    df = spark.createDataFrame([*texts, (None, "the a"), (999, None)], "id long, body string")
    given = spark.createDataFrame(terms, "term_id long, term string, whole boolean")
    joined = patterns.match_terms(df, "id", "body", given, limit=0)
    rows = lambda found: sorted(map(tuple, found.collect()), key=str)
    assert rows(joined) == rows(patterns.match_terms(df, "id", "body", given)) != []
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "candidates" not in plan and plan.count("MapInArrow") == 1
