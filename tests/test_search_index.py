import random
import re

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import search
from lexquarry.operators import search_index as si
from lexquarry.plans.search_queries import RULES

WORDS = "license licensed apache secret password token idiot stupid version key https http link english german alpha beta gamma tokens keys cat concat catalog".split()
REQUESTS = [
    "license", "secret", "insult", "which license holds", "password or token", "alpha beta gamma", "german license", "english secret key", "version of apache", "https link http",
    "stupid idiot", "cat", "concat catalog", "tokens and keys", "beta", "gamma german insult", "apache license version key", "nothing here matches", "key", "alpha secret license insult",
]


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 3, 9, 40, 200]))), rng.choice(["en", "de", None]), f"s{i % 3}") for i in range(1500)]
    rows += [(7, "license license apache", "en", "again"), (None, "secret token for nobody", "de", "s1"), (1600, None, "en", "s1"), (1601, "", "de", "s2"), (1602, "token" * 400, "en", "s1"), (1603, "LICENSE; Apache-License!", "de", None)]
    return spark.createDataFrame(rows, "id long, body string, lang string, source string").repartition(5).cache()


@pytest.fixture(scope="module")
def built(chunks, tmp_path_factory):
    before = si.BLOCK
    si.BLOCK = 50
    folder = str(tmp_path_factory.mktemp("index") / "i")
    yield folder, si.build_index(chunks, folder, "id", "body", ["lang", "source"])
    si.BLOCK = before


def _rows(df):
    return [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]


def _best(chunks, request, k):
    return si.scan(chunks, request, RULES, "id", "body", ["lang", "source"], kind="lang").orderBy(F.desc("score"), "key").limit(k)


def _same(found, wanted):
    assert sorted(_rows(found), key=repr) == sorted(_rows(wanted), key=repr)


@pytest.mark.parametrize("text", REQUESTS)
def test_equals_a_scan(chunks, built, text):
    request = search.understand(text, RULES)
    k = 3 if len(text) % 2 else 40
    _same(si.search(built[1], request, RULES, k, kind="lang"), _best(chunks, request, k))


def test_only_the_buckets_and_blocks_of_a_request_are_read(built):
    request = search.understand("license", RULES)
    points = si._Points.of(request, RULES)
    found = si._of_tokens(built[1], points.tokens)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (= \d+|IN \()", plan) and re.search(r"PushedFilters: \[.*(In|EqualTo)\(token", plan)
    files = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(files) < len(built[1].table("postings-0").inputFiles())


def test_blocks_that_cannot_reach_the_floor_are_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(si, "BLOCK", 10)
    monkeypatch.setattr(si, "FIRST", 1)
    rows = spark.createDataFrame([(i, "cat " * (12 if i < 30 else 1)) for i in range(2000)], "id long, body string").coalesce(1)
    version = si.build_index(rows, str(tmp_path / "i"), "id", "body")
    read = []
    real = si._rows
    monkeypatch.setattr(si, "_rows", lambda v, p, kind, blocks: read.append(blocks) or real(v, p, kind, blocks))
    got = si.search(version, search.understand("cat", RULES), RULES, 25).collect()
    assert [(r.key, r.score) for r in got] == [(i, 76) for i in range(25)]
    assert sum(len(b) if isinstance(b, list) else b.count() for b in read) < 30  # of 200


def test_many_blocks_are_joined(chunks, built, monkeypatch):
    monkeypatch.setattr(si, "NAMED", 2)
    request = search.understand("alpha beta gamma", RULES)
    _same(si.search(built[1], request, RULES, 200, kind="lang"), _best(chunks, request, 200))


def test_update_replaces_and_removes(spark, chunks, built):
    folder, first = built
    changed = spark.createDataFrame([(7, "password", "de", "n"), (5000, "license token", "en", "n"), (8, None, "en", "n")], "id long, body string, lang string, source string")
    removed = spark.createDataFrame([(9,), (10,), (99999,)], "id long")
    second = si.update_index(changed, folder, "id", "body", removed=removed)
    third = si.update_index(spark.createDataFrame([(5000, "secret", "de", "m")], changed.schema), folder, "id", "body")
    now = chunks.where("id IS NULL OR id NOT IN (7, 8, 9, 10)").unionByName(changed)
    later = now.where("id IS NULL OR id <> 5000").unionByName(spark.createDataFrame([(5000, "secret", "de", "m")], changed.schema))
    for text in ("license", "secret", "password or token", "beta"):
        request = search.understand(text, RULES)
        for version, table in ((first, chunks), (second, now), (third, later)):
            _same(si.search(version, request, RULES, 2000, kind="lang"), _best(table, request, 2000))


def test_requests_that_the_index_cannot_serve(built, chunks, spark, tmp_path):
    none = si.search(built[1], search.understand("of the", RULES), RULES, 5)
    assert none.count() == 0 and none.columns == ["key", "lang", "source", "hits", "score"]
    rules = search.Rules(expansions={"law": ("water law",)})
    with pytest.raises(ValueError, match="holds words"):
        si.search(built[1], search.understand("law", rules), rules, 5)
    empty = si.build_index(chunks.limit(0), str(tmp_path / "e"), "id", "body", ["lang"])
    assert si.search(empty, search.understand("license", RULES), RULES, 5).count() == 0


def test_occurrences_of_words_inside_words():
    rng = random.Random(2)
    for _ in range(200):
        text = " ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 40)))
        assert si.occurrences(text) == {w: min(text.count(w), 12) for w in set(text.split()) if len(w) >= 3}
    assert si.occurrences("x" * 65 + " xxx") == {"xxx": 12}


def test_short_and_long_texts_count_alike(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice([*WORDS, "aaa", "aaaaaaa", "ab"]) for _ in range(rng.randrange(1, 300))) for _ in range(40)]
    short = [si.occurrences(x) for x in texts]
    monkeypatch.setattr(si, "_SHORT", 0)
    assert short == [si.occurrences(x) for x in texts]


def test_postings_are_made_without_a_shuffle_of_them(spark, chunks, monkeypatch):
    """Chunks are shuffled once, by their keys; a block's postings are whole, and cut ones add up to them."""
    seen = []
    save = si.save
    monkeypatch.setattr(si, "save", lambda df, label: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or save(df, label))
    tables, made = si._segment(chunks, "id", "body", ["lang", "source"], 3)
    assert len(seen) == 1 and seen[0].count("RepartitionByExpression") == 1 and "Aggregate" not in seen[0] and "Window" not in seen[0]
    docs = {(r.block, r.at): r for r in tables["docs-3"].rows.collect()}
    assert len(docs) == chunks.count() and {b >> 48 for b, _ in docs} == {3}
    texts = {r.id: r.body for r in chunks.where("id IS NOT NULL AND id <> 7").collect()}
    got = {}
    for r in tables["postings-3"].rows.collect():
        assert r.n == len(r.rows) and r.most == max(x.n for x in r.rows) and (r.block, r.token) not in got
        got[r.block, r.token] = {x["at"]: x.n for x in r.rows}
    for place, row in docs.items():
        if row.key in texts:
            words = re.sub("[^a-z0-9]+", " ", (texts[row.key] or "").lower()).strip()
            assert {t: own[place[1]] for (b, t), own in got.items() if b == place[0] and place[1] in own} == si.occurrences(words)
    cut = made.sparkSession.createDataFrame([(1, "aaa bbb aaa"), (2, "aaa ccc")], "key long, __norm string").coalesce(1)
    parts = cut.mapInArrow(si._posted(4096, 0, most=1), "block long, at int, c0 long, token string, most int, n int, rows array<struct<at:int,n:int>>").where("token = 'aaa'").collect()
    assert sorted((r.block, r.most, r.n, r.rows[0]["at"]) for r in parts) == [(0, 1, 1, 1), (0, 2, 1, 0)]
