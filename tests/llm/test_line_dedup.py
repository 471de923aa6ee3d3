import random
import re

import pyarrow as pa

from lexquarry.llm import _text as tx
from lexquarry.llm import line_dedup as ld


def line_hashes(lines):
    """Each line's hash, on its own."""
    import numpy as np

    raw = [x.encode() for x in lines]
    ends = np.cumsum([len(x) for x in raw])
    starts = ends - [len(x) for x in raw]
    return tx.hash_spans(np.frombuffer(b"".join(raw), np.uint8), starts, ends)


def is_long(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= ld.LONG_WORDS


def chunks(text):
    import numpy as np

    if not text:
        return []
    lines = text.split("\n")
    at = ld.chunk_bounds(np.zeros(len(lines), np.int64), line_hashes(lines), np.array([is_long(x) for x in lines])).tolist()
    return [(a, lines[a:b]) for a, b in zip(at, at[1:] + [len(lines)])]


def brute(docs):
    unique = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    seen, out = {}, {}
    for d in unique:
        keep = []
        for a, lines in chunks(d[1]):
            if (len(lines) >= ld.LEAST_LINES or is_long(lines[0])) and tuple(lines) in seen:
                continue
            seen[tuple(lines)] = d
            keep += lines
        n = d[1].count("\n") + 1 if d[1] else 0
        out[d] = (d[0], n, n - len(keep), "\n".join(keep) if d[1] and len(keep) < n else d[1])
    return sorted((out[d] for d in docs), key=str)


def test_matches_brute_force_over_text_chunks(spark, corpus):
    rng = random.Random(8)
    passage = [f"shared line {i} " + "words " * 9 for i in range(14)]
    docs = [(c[0], c[1]) for c in corpus if c[0] is not None]
    for i in range(40):
        own = ["long one " * 30] * (i % 3) + [f"own {i} {k} {rng.random()}" for k in range(rng.randrange(0, 12))]
        k = rng.randrange(len(own) + 1)
        docs.append((3000 + i, "\n".join(own[:k] + passage[rng.randrange(3) :] + own[k:]) + ("\n" if i % 5 == 0 else "")))
    docs += [docs[-1], (5000, "\n\n\n\n"), (5001, "a\n\na\n\na\n\n"), (5002, "\n" * 300), (5003, "é\nü\n" * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in ld.remove_repeated_lines(df).collect()), key=str)
    assert got == brute(docs)
    assert sum(r[2] for r in got if 3000 <= r[0] < 4000) > 200


def test_equal_hashes_with_other_bytes_stay(spark, monkeypatch):
    monkeypatch.setattr(tx, "hash_spans", lambda raw, a, b: (b - a).astype("uint64"))
    docs = [(1, "aaaa\nbbbb\ncccc\ndddd"), (2, "eeee\nffff\ngggg\nhhhh"), (3, "aaaa\nbbbb\ncccc\ndddd")]
    h = [ld._chunks(pa.array([t]))[5].tolist() for _, t in docs]
    assert h[0] == h[1] == h[2]  # hashes by length collide; bytes must decide
    rows = [(k, i, line, c) for k, (i, _) in enumerate(docs) for line, c in zip(ld._chunks(pa.array([docs[k][1]]))[6].tolist(), h[k])]
    assert rows
    batch = pa.RecordBatch.from_pylist([{"key": i, "doc_id": i, "text": t, "lines": [0]} for i, t in docs])
    out = next(ld._chunk_bytes([batch])).column("bytes").to_pylist()
    assert out[0] == out[2] != out[1]


def test_empty(spark):
    assert ld.remove_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_passages(docs):
    """Lines of runs of PASSAGE_WORDS words or more (between lines with words) that an earlier text holds, by comparing all pairs of runs."""
    lines = {d: t.split("\n") for d, t in docs}
    size = {d: [len(x.split()) for x in ls] for d, ls in lines.items()}
    out = {}
    for d, ls in lines.items():
        gone = set()
        for e in (e for e in lines if e < d):
            for i in range(len(ls)):
                for j in range(len(lines[e])):
                    k = 0
                    while i + k < len(ls) and j + k < len(lines[e]) and ls[i + k] == lines[e][j + k]:
                        k += 1
                    full = [x for x in range(i, i + k) if size[d][x]]
                    if full and sum(size[d][x] for x in full) >= ld.PASSAGE_WORDS:
                        gone |= set(range(full[0], full[-1] + 1))
        out[d] = gone
    return out


def test_every_repeated_passage_goes_whole(spark):
    rng = random.Random(21)
    docs = []
    for n in range(2, 12):  # passages of n lines, each in three texts between lines of their own
        for copy in range(3):
            passage = [f"passage {n} line {i} " + "word " * (47 // n + 1) + f"end{i}" + ("\n" if i % 4 == 3 else "") for i in range(n)]
            own = [f"own {n} {copy} {k} {rng.random()}" for k in range(8)]
            at = rng.randrange(9)
            docs.append((100 * n + copy, "\n".join(own[:at] + passage + own[at:])))
    docs += [(5000, "short shared\nand few words\nhere it ends"), (5001, "x\nshort shared"), (5002, "\n" * 3000 + "a b c"), (5003, "again and again\n" * 90)]
    want = brute_passages(docs)
    got = {r.doc_id: r for r in ld.remove_repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    for d, text in docs[:-4]:
        kept = [x for i, x in enumerate(text.split("\n")) if i not in want[d]]
        assert got[d].text.split("\n") == kept
    assert sum(r.n_removed > 0 for r in got.values() if r.doc_id < 5000) == 20
    assert [got[d].text for d in (5000, 5001)] == [docs[-4][1], docs[-3][1]]
    assert set(got[5003].text.split("\n")) == {"again and again", ""}


def test_cover_holds_all_places():
    rng = random.Random(2)
    for _ in range(300):
        spans = [(rng.randrange(40), rng.randrange(1, 9)) for _ in range(rng.randrange(1, 15))]
        own = [spans[i] for i in ld.cover(spans)]
        places = [x for a, n in own for x in range(a, a + n)]
        assert set(places) == {x for a, n in spans for x in range(a, a + n)}
        assert all(places.count(x) <= 2 for x in places)


def test_null_ids_clashing_names_and_long_texts(spark):
    passage = "\n".join(f"shared line {k} " + "word " * 12 for k in range(6))
    docs = [(None, passage + "\nown end"), (1, "own start\n" + passage), (2, None), (3, ""), (4, "x" * 3_000_000 + "\n" + passage), (4, "x" * 3_000_000 + "\n" + passage)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS lines", "'r' AS runs", "3 AS chunk", "4 AS line", "5 AS n").repartition(3)
    got = sorted(((r.doc_id, r.n_removed, r.text) for r in ld.remove_repeated_passages(df).collect()), key=str)
    by = {}
    for d, n, text in got:
        by.setdefault(d, []).append((n, text))
    assert by[None] == [(0, docs[0][1])]  # a null id sorts first and keeps the passage
    assert by[1] == [(6, "own start")] and by[2] == [(0, None)] and by[3] == [(0, "")]
    assert by[4] == [(6, "x" * 3_000_000)] * 2
