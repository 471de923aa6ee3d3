import math
import random
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import functions as F

from lexquarry.llm import quality_classifier as qc


def test_held_out_accuracy(spark):
    """Held-out labels, over all languages; and, more strictly, toxic texts with telling English words.

    Telling words are those of many toxic training texts and of hardly any other.
    Some labels follow from nothing in the text, so agreement cannot be complete.
    """
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    words = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{4,}"), F.lit(0)))).alias("word"))
    train, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("is_toxic"), F.col("quality").alias("is_good"))
    telling = words.join(train, "doc_id").groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).where("t >= 40 AND t >= 0.9 * n").select("word")
    told = words.join(telling, "word").groupBy("doc_id").agg(F.count("*").alias("hits"))
    rows = qc.classify_documents(docs, train).join(held, "doc_id").join(told, "doc_id", "left").collect()
    sure = [r for r in rows if r.is_toxic and r.hits]
    assert len(sure) > 100 and sum(r.toxic for r in sure) >= 0.98 * len(sure)
    print([sum(x) for x in zip(*((bool(r.is_toxic), r.toxic, bool(r.is_toxic and r.toxic), not r.is_toxic and r.toxic) for r in rows))])
    toxic = [r for r in rows if r.is_toxic]
    assert sum(r.toxic for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.toxic and not r.is_toxic for r in rows) <= 0.01 * len(rows)
    assert sum(r.toxic == (r.is_toxic == 1) for r in rows) >= 0.965 * len(rows)
    assert sum((r.quality >= 0.5) == (r.is_good == 1) for r in rows) >= 0.95 * len(rows)


def test_one_row_per_document(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert qc.classify_documents(documents, labels).count() == documents.count()


def test_sparse_sites_are_shrunk(spark, documents):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    rows = qc.classify_documents(documents, labels).collect()
    assert len(rows) == documents.count() and all(0 <= r.quality <= 1 for r in rows)
    empty = [r for r in rows if r.doc_id in (92, 93)]
    assert len(empty) == 2 and all(0.3 < r.quality < 0.7 for r in empty)


def test_no_labels_and_no_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert qc.classify_documents(documents, none).count() == documents.count()
    assert qc.classify_documents(documents.limit(0), none).count() == 0


def _plain_fusion(rows, e, rates):
    """``p_document, p_host, p_path, posterior`` of each (key, host, path) with its evidence, a row and a label at a time."""
    out = {key: [] for key, _, _ in rows}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for k, share in enumerate(rates):
        d = {key: sigmoid(e[key][k] + math.log(share / (1 - share))) for key, _, _ in rows}
        hosts, paths = {}, {}
        for key, host, path in rows:
            hosts.setdefault(host, []).append(d[key])
            paths.setdefault((host, path), []).append(d[key])
        mean = min(max(sum(d.values()) / len(d), 1e-6), 1 - 1e-6)

        def strength(sites, mean=mean):
            sites = [s for s in sites.values() if len(s) >= 2]
            n = sum(len(s) for s in sites)
            if not n:
                return qc.MOST_STRENGTH
            spread = (sum(len(s) * (sum(s) / len(s) - mean) ** 2 for s in sites) - mean * (1 - mean) * len(sites)) / n
            return min(qc.MOST_STRENGTH, max(qc.LEAST_STRENGTH, mean * (1 - mean) / spread - 1)) if spread > 0 else qc.MOST_STRENGTH

        by_host, by_path = strength(hosts), strength(paths)
        for key, host, path in rows:
            own, site = hosts[host], paths[host, path]
            p_host = (sum(own) - d[key] + by_host * mean) / (len(own) - 1 + by_host)
            p_path = (sum(site) - d[key] + by_path * p_host) / (len(site) - 1 + by_path)
            inside = min(max(p_path, 1e-6), 1 - 1e-6)
            out[key].append((d[key], p_host, p_path, sigmoid(e[key][k] + math.log(inside / (1 - inside)))))
    return out


def test_fusion_matches_brute_force(spark):
    draw = random.Random(6)
    words = {1: "clear careful tested sound".split(), 0: "spam buy cheap click".split()}
    fit = [(" ".join(draw.choice(words[i % 2]) for _ in range(20)), i % 2) for i in range(80)]
    learned = qc.fit_weights(spark.createDataFrame(fit, "text string, label int"))
    hosts = {"good.example": 0.9, "bad.example": 0.1, "mixed.example": 0.5}
    rows = [(i, (h := draw.choice(list(hosts))), f"{h}/{draw.randrange(4)}", " ".join(draw.choice(words[int(draw.random() < hosts[h])]) for _ in range(draw.randrange(0, 5)))) for i in range(200)]
    rows += [(300, "lone.example", "lone.example/x", "clear"), (301, None, None, None), (302, None, None, "buy"), (303, "good.example", None, "")]
    df = spark.createDataFrame(rows, "key long, host string, path string, text string").repartition(3)
    evidence, rates = [learned, learned], [0.5, 0.2]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[3] for r in rows], pa.string())], names=["key", "text"])
    e = {r["key"]: (r["e0"], r["e1"]) for part in qc._evidence(SimpleNamespace(value=evidence))(iter([batch])) for r in part.to_pylist()}
    want = _plain_fusion([(key, host or "", path or "") for key, host, path, _ in rows], e, rates)
    got = {r.key: r for r in qc.classify(df, evidence, rates, ["key"]).collect()}
    assert set(got) == set(want) and len({x for x, _ in e.values()}) > 10
    for key, labels in want.items():
        for k, parts in enumerate(labels):
            for value, name in zip(parts, ("p_document", "p_host", "p_path", "posterior"), strict=True):
                assert abs(got[key][name][k] - value) < 2e-6, (key, name, k)
