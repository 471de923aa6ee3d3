import random
import re

from lexquarry.llm import quality_rules as qr


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, hit = {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_counts_match_brute_force(spark, documents, corpus):
    odd = [(2000, "a b c d e f a b c d e g # h\n\n x\n x\ny | z"), (2001, "\x0bone\x0ctwo three 😀😀 ###"), (2002, "q " * 7), (2003, "a b c d")]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in qr.judge(df).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in [(c[0], c[1]) for c in corpus] + odd), key=str)


def test_posterior_separates_bad_from_good(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    good = [(i, "\n".join(" ".join(word() for _ in range(12)).capitalize() + "." for _ in range(8))) for i in range(300)]
    bad = [(1000 + i, "\n".join(" ".join(word().upper() + "### |" for _ in range(4)) for _ in range(12))) for i in range(60)]
    out = qr.judge(spark.createDataFrame(good + bad, "doc_id long, text string"))
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert kept == {i for i, _ in good}
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_em(rows):
    """EM over single rows of votes, without patterns or DataFrames."""
    import math

    good = {(r, v): qr.START["good"][v + 1] for r in qr.RULES for v in (-1, 0, 1)}
    bad = {(r, v): qr.START["bad"][v + 1] for r in qr.RULES for v in (-1, 0, 1)}
    p = qr.START_GOOD

    def posterior(votes):
        odds = math.log(p / (1 - p)) + sum(math.log(good[r, v] / bad[r, v]) for r, v in zip(qr.RULES, votes))
        return 1 / (1 + math.exp(-odds))

    for _ in range(qr.ROUNDS):
        post = [posterior(v) for v in rows]
        g, b = sum(post), sum(1 - x for x in post)
        old = dict(good) | {("bad", *k): x for k, x in bad.items()} | {"p": p}
        eg, eb = qr.PRIOR_ROWS * qr.START_GOOD, qr.PRIOR_ROWS * (1 - qr.START_GOOD)
        for k, r in enumerate(qr.RULES):
            for v in (-1, 0, 1):
                good[r, v] = (sum(x for x, votes in zip(post, rows) if votes[k] == v) + eg * qr.START["good"][v + 1]) / (g + eg)
                bad[r, v] = (sum(1 - x for x, votes in zip(post, rows) if votes[k] == v) + eb * qr.START["bad"][v + 1]) / (b + eb)
        p = (g + eg) / (g + b + qr.PRIOR_ROWS)
        new = dict(good) | {("bad", *k): x for k, x in bad.items()} | {"p": p}
        if max(abs(new[k] - old[k]) for k in new) < 1e-4:
            break
    return [posterior(v) for v in rows]


def test_posteriors_match_plain_em(documents):
    clash = documents.selectExpr("*", "1 AS length", "2 AS n", "'x' AS good", "0 AS votes")
    rows = qr.judge(clash).collect()
    want = plain_em([tuple(r.votes) for r in rows])
    assert all(abs(r.posterior - w) < 2e-6 for r, w in zip(rows, want, strict=True))
    assert all(r.kept == (not r.base_failed and w >= 0.5) for r, w in zip(rows, want, strict=True) if abs(w - 0.5) > 1e-5)


def test_empty(spark):
    assert qr.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0
