import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexquarry.llm import lm_score as lm


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def brute(docs):
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    counts = Counter(t for (d, x), h in zip(docs, held) if not h for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, x), h in zip(docs, held):
        toks = tokens(x)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in toks)
        out.append((d, h, len(toks), sum(counts[t] > 0 for t in toks), n, base))
    return sorted(out, key=lambda r: (str(r[:5]), r[5]))


@pytest.mark.parametrize("hot", [1 << 19, 5])
def test_base_is_exact(spark, documents, corpus, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT", hot)
    got = sorted((tuple(r) for r in lm.score_documents(documents).collect()), key=lambda r: (str(r[:5]), r[5]))
    want = brute([(c[0], c[1]) for c in corpus])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want))
    assert all(g[6] < 0 for g in got)


def one_slot(grams, counts):
    prints = (grams >> np.uint64(32)).astype(np.uint32)
    packed, stats = lm._fill(prints, counts, np.ones(len(grams), dtype=bool), lm.BITS_PER_EVENT)
    means = lm._level_means({(s, k): (n, t) for s, rows in stats.items() for k, n, t in rows})
    return packed, means


@pytest.mark.parametrize("n", [3000, 30_000])
def test_filter_returns_the_quantised_counts_at_any_size(n):
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    counts = np.maximum(1, (rng.pareto(1.0, len(grams)) * 3).astype(np.int64))
    packed, means = one_slot(grams, counts)
    model = lm.Filter(np.array([8 * len(packed)], np.uint64), packed)
    found = means[2][model.levels(grams)]
    want = means[2][lm.level_of(counts)]
    assert (found >= want).all() and np.mean(found == want) > 0.97
    unseen = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert np.mean(model.levels(unseen) > 0) < 0.03


def quantised(counts):
    level = {g: int(lm.level_of(np.array([c]))[0]) for g, c in counts.items()}
    sums = {}
    for g, c in counts.items():
        n, t = sums.get(level[g], (0, 0))
        sums[level[g]] = (n + 1, t + c)
    return {g: sums[k][1] / sums[k][0] for g, k in level.items()}


def brute_scores(docs):
    """The smoothed bigram over exact level means, without a filter."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    texts = [tokens(x) for _, x in docs]
    words = Counter(t for x, h in zip(texts, held) if not h for t in x)
    pairs = Counter(p for x, h in zip(texts, held) if not h for p in zip(["<start>", *x], x))
    n, v, starts = sum(words.values()), len(words), held.count(False)
    words_q, pairs_q = quantised({**words, "<start>": starts}), quantised(pairs)
    out = []
    for (d, x), toks in zip(docs, texts):
        total = 0.0
        for h, w in zip(["<start>", *toks], toks):
            single = (words_q.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))
            history = words_q.get(h, 0)
            total += math.log10((min(pairs_q.get((h, w), 0), history, words_q.get(w, 0)) + lm.K * single) / (history + lm.K))
        out.append((str(d), len(toks), total))
    return sorted(out)


def test_scores_match_brute_force_and_both_ways_agree(spark, documents, corpus, monkeypatch):
    monkeypatch.setattr(lm, "BITS_PER_EVENT", 64)  # hardly any false hits
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_documents(documents).collect())
    want = brute_scores([(c[0], c[1]) for c in corpus])
    assert all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-3) for a, b in zip(got, want, strict=True))
    monkeypatch.setattr(lm, "BITS_PER_EVENT", 4)
    whole = sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_documents(documents).collect())
    monkeypatch.setattr(lm, "MODEL_BYTES", 0)
    assert sorted((str(r.doc_id), r.n_tokens, r.score) for r in lm.score_documents(documents).collect()) == whole


def test_pairs_beat_words_on_held_out_text(spark):
    verse = "to be or not to be that is the question whether tis nobler in the mind".split()
    docs = [(i, " ".join(verse[(i + k) % len(verse)] for k in range(60))) for i in range(200)]
    held = lm.score_documents(spark.createDataFrame(docs, "doc_id long, text string")).where("held_out")
    a, b = held.groupBy().sum("score", "base_score").first()
    assert a > 0.9 * b and a > b


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(df).count() == 0


def lists(slots, grams, counts, each):
    """Rows of ``each`` grams, sorted by slot."""
    offsets = pa.array(np.append(np.arange(0, len(grams), each), len(grams)).astype(np.int32))
    n = len(offsets) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(slots[::each]), pa.array(np.full(n, 2, np.int32)), pa.ListArray.from_arrays(offsets, pa.array(grams.view(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts))], names=["slot", "size", "grams", "counts"]
    )


def test_building_does_not_go_by_the_number_of_rows():
    rng = np.random.default_rng(4)
    n = 1 << 19
    slots = np.repeat(np.arange(8, dtype=np.int32), n // 8)
    grams, counts = rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(1, 5, n)
    took, built = [], []
    for each in (512, 1):
        batch = lists(slots, grams, counts, each)
        began = time.process_time()
        built.append([r for x in lm._build(8)(batch.slice(i, 50_000) for i in range(0, len(batch), 50_000)) for r in x.to_pylist()])
        took.append(time.process_time() - began)
    assert built[0] == built[1] and len(built[0]) == 8
    assert took[1] < 2 * took[0] + 0.3


def test_frequent_pairs_leave_a_task_once(monkeypatch):
    monkeypatch.setattr(lm, "WINDOW", 1000)
    texts = pa.RecordBatch.from_arrays([pa.array(["of the " * 200 + f"w{i}" for i in range(60)])], names=["text"])
    rows = [r for b in lm._pair_counts(64)(iter([texts])) for r in b.to_pylist()]
    got = {}
    entries = Counter()
    for r in rows:
        for g, c in zip(r["grams"], r["counts"]):
            got[r["slot"], g] = got.get((r["slot"], g), 0) + c
            entries[r["slot"], g] += 1
    assert sorted(got.values())[-2:] == [60 * 199, 60 * 200]
    top = sorted(got, key=got.get)[-2:]
    assert all(entries[k] == 1 for k in top)


def test_a_vocabulary_ten_times_as_large_by_either_way(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 60_000, 400))) for i in range(250)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(lm, "SLOT_TOKENS", 1 << 9)  # few grams of a slice in each slot
    told = lambda: sorted(tuple(r) for r in lm.score_documents(df).collect())
    whole = told()
    monkeypatch.setattr(lm, "MODEL_BYTES", 0)
    assert told() == whole
