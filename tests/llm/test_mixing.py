import math
from collections import Counter, defaultdict

import pytest
import xxhash

from lexquarry.llm import mixing as mx


def shares(corpus):
    t = Counter()
    for c in corpus:
        t[c[3] or ""] += len((c[1] or "").split())
    return t


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_ROWS", 4)


def test_repetition_limit_and_budgets(documents, corpus, small_blocks):
    rows = mx.mixture(documents, repetition=1.5).collect()
    t = shares(corpus)
    assert len(rows) == len(corpus)
    a = rows[0].exponent
    z = sum((v / sum(t.values())) ** a for v in t.values() if v)
    passes = {}
    for r in rows:
        assert math.isclose(r.weight, (t[r.source] / sum(t.values())) ** a / z, rel_tol=1e-9)
        passes[r.source] = r.passes
    assert math.isclose(min(passes.values()), 1.0, rel_tol=1e-9)
    assert 1.499 <= max(passes.values()) <= 1.5 + 1e-9
    taken, order = Counter(), defaultdict(list)
    for r in rows:
        assert r.repeats >= 1
        taken[r.source] += r.repeats * r.n_tokens
        order[r.source].append((r.tokens_before, r.n_tokens))
    for s, places in order.items():
        at = 0
        for before, n in sorted(places):
            assert before == at or n == 0
            at += n
        longest = max(n for _, n in places)
        assert passes[s] * t[s] - longest <= taken[s] <= passes[s] * t[s] + 1e-3


def test_entropy_target(documents, corpus):
    t = [v for v in shares(corpus).values() if v]
    proportional = -sum(v / sum(t) * math.log(v / sum(t)) for v in t)
    target = (proportional + math.log(len(t))) / 2
    rows = mx.mixture(documents, entropy=target, repetition=None).collect()
    w = {r.source: r.weight for r in rows}
    assert math.isclose(-sum(x * math.log(x) for x in w.values() if x), target, abs_tol=1e-5)


def test_entropy_out_of_reach(documents):
    for target in (0.01, 99.0):
        with pytest.raises(ValueError):
            mx.mixture(documents, entropy=target, repetition=None)


def test_mix_repeats_rows(documents, corpus, small_blocks):
    want = Counter()
    for r in mx.mixture(documents, budget=3 * sum(shares(corpus).values())).collect():
        want[r.doc_id] += r.repeats
    out = mx.mix(documents, budget=3 * sum(shares(corpus).values()))
    assert out.columns == documents.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in want.items() if v})
    plan = mx.mixture(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(documents):
    assert mx.mix(documents.limit(0)).count() == 0


def _hashed(*values):
    """Spark's 64-bit hash of integers of 4 bytes (int), of 8 (a tuple) and texts, as a signed number."""
    seed = 42
    for v in values:
        if v == (None,):
            continue
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(8, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(4, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


@pytest.mark.parametrize("budget", [None, 9000])
def test_places_and_repeats_match_brute_force(documents, corpus, small_blocks, budget):
    rows = mx.mixture(documents, repetition=1.5, budget=budget).collect()
    t = {s: n for s, n in shares(corpus).items()}
    whole = sum(t.values())
    logs = [math.log(n / whole) for n in t.values() if n]
    exponent = rows[0].exponent
    assert math.isclose(exponent, max(0.0, 1 - math.log(1.5) / (max(logs) - min(logs))), abs_tol=1e-6)
    power = {s: (n / whole) ** exponent if n else 0.0 for s, n in t.items()}
    z = sum(power.values())
    spent = budget if budget is not None else max(t[s] / power[s] for s in t if power[s]) * z
    want = []
    for s in t:
        passes = spent * power[s] / z / t[s]
        full = math.floor(passes + 1e-9)
        rest = max(0.0, (passes - full) * t[s] + 1e-6)
        own = [(c[0], c[1] or "") for c in corpus if (c[3] or "") == s]
        blocks = -(-len(own) // 4)
        dealt = defaultdict(list)
        for doc_id, text in own:
            draw = _hashed(mx.SEED, (doc_id,), text)
            dealt[draw % blocks].append((_hashed(mx.SEED + 2, (draw,)), draw, doc_id, len(text.split())))
        at = 0
        for b in sorted(dealt, key=lambda b: (_hashed(mx.SEED + 1, (b,)), b)):
            for _, _, doc_id, n in sorted(dealt[b], key=lambda x: x[:2]):
                want.append((s, b, at, doc_id, n, full + (at + n <= rest) if n else max(1, full)))
                at += n
    plain = lambda rs: sorted(rs, key=repr)
    assert plain((r.source, r.block, r.tokens_before, r.doc_id, r.n_tokens, r.repeats) for r in rows) == plain(want)
