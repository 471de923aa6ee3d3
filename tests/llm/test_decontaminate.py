import hashlib
import re

from lexquarry.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            k = min(13, len(v))
            wins = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i : i + k]) in wins:
                    hit.update(range(i, i + k))
                    found.add("null" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_matches_brute_force(spark, documents, corpus):
    whole = corpus[5][1] + " tail " + corpus[9][1]
    items = [(1, whole), (2, "alpha beta"), (3, "one"), (4, corpus[70][1]), (5, corpus[70][1]), (6, None), (7, ""), (8, "..."), (None, corpus[12][1]), (9, "lorem " * 30), (2, "beta of"), (10, " ".join(f"w{i}" for i in range(20, 33)))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(documents, bench)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()), key=str)
    assert rows == brute([(c[0], c[1]) for c in corpus], items)
    kept = decontaminate(documents, bench)
    assert kept.columns == documents.columns
    assert kept.count() == sum(not r[-1] for r in rows)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(documents, none).where("n_hit > 0 or contaminated").count() == 0
    assert contamination(documents.limit(0), none).count() == 0
