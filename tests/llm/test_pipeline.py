"""The pipeline against a brute-force version on a small planted corpus."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import DOC_SCHEMA


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _groups(docs):
    """Positions of the rows that stay: the first of each group linked at 0.8, and wordless rows."""
    sets, root = [_shingles(d[1]) for d in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [i for i in range(len(docs)) if find(i) == i]


@pytest.fixture(scope="module")
def planted(spark, corpus, tmp_path_factory):
    rows = [r for r in corpus if r[0] is not None]
    passage = " ".join(f"quiz{i}" for i in range(20))
    rows += [(200, passage + " and more", "en", "s1", 1, "k"), (201, None, None, None, None, None)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_stages(spark, planted):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, folder).collect()
    assert {r.doc_id for r in known} >= {r[0] for r in rows if r[1] and re.search("[a-z]", r[1].lower()) and len(r[1]) > 40}
    docs = spark.createDataFrame(known, docs.schema)
    kept = stages["jaccard_dedup"](spark, docs, folder)
    assert kept.columns == columns
    ordered = sorted({tuple(r) for r in known}, key=lambda r: r[0])
    assert sorted(r.doc_id for r in kept.collect()) == [ordered[i][0] for i in _groups(ordered)]
    clean = stages["decontamination"](spark, kept, folder)
    assert {r.doc_id for r in kept.collect()} - {r.doc_id for r in clean.collect()} == {200}
    mixed = stages["source_mixing"](spark, clean, folder)
    assert mixed.columns == columns
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in clean.collect()}


def test_run_shards_what_is_left(spark, planted):
    folder, _ = planted
    rows = corpus_pipeline.run(spark, folder).collect()
    slots = Counter((r.shard, r.slot) for r in rows)
    assert rows and max(slots.values()) == 1 and 200 not in {r.doc_id for r in rows}


def test_empty_table(spark, planted, tmp_path):
    spark.read.parquet(f"{planted[0]}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{planted[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_ids_stay_apart(spark, planted, tmp_path):
    texts = [" ".join(f"{name}{k} the and of with" for k in range(12)) for name in ("fire", "water", "earth")]
    rows = [(None, t, "en", "s1", 1, "k") for t in texts] + [(None, texts[0], "en", "s1", 1, "k"), (5, texts[0] + " more", "en", "s2", 1, "k")]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{planted[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted(r.text.split()[0] for r in kept) == ["earth0", "fire0", "water0"]
    assert corpus_pipeline.run(spark, str(tmp_path)).select("size").distinct().count() >= 2
