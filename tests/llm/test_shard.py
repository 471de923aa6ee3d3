import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from lexquarry.llm import shard as sh


def check(rows, texts, shards):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    mean = sum(sizes.values()) / shards
    worst = max(r.size for r in rows)
    assert all(abs(sizes[k] - mean) <= worst for k in range(shards))


def test_small(spark, documents, corpus):
    check(sh.assign_shards(documents, 3).collect(), [(c[0], c[1]) for c in corpus], 3)
    assert sh.assign_shards(documents.limit(0)).count() == 0


def test_one_text_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(sh, "LEAST_RANGES", 16)
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same text")).otherwise(F.repeat(F.lit("é"), (F.col("id") % 90).cast("int"))).alias("text"))
    df = df.unionByName(spark.range(2000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same row").alias("text")))
    texts = [(r.doc_id, r.text) for r in df.collect()]
    check(sh.assign_shards(df).collect(), texts, 24)


@pytest.mark.parametrize("ranges", [1, 16, 256])
def test_places_match_one_sort(documents, corpus, monkeypatch, ranges):
    """Whatever ranges are drawn, rows lie as one sort by (hash of the text, id) puts them, and shards are cut at equal bytes."""
    monkeypatch.setattr(sh, "LEAST_RANGES", ranges)
    rows = []
    for doc_id, text, *_ in corpus:
        raw = (text or "").encode()
        h = xxhash.xxh64_intdigest(raw, 42)
        rows.append((h - (1 << 64) if h >> 63 else h, -1 if doc_id is None else doc_id, len(raw) + 8, zlib.crc32(raw), doc_id))
    rows.sort(key=lambda r: r[:2])
    total, at, want, first = sum(r[2] for r in rows), 0, [], {}
    for place, (_, _, size, crc, doc_id) in enumerate(rows):
        shard = min(6, (at + size // 2) * 7 // total)
        want.append((doc_id, size, crc, shard, place - first.setdefault(shard, place)))
        at += size
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sh.assign_shards(documents, 7).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
