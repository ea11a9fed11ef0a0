import collections
import math
import random
import zlib

import pytest

from cardamom.llm.lm_scoring import lm_score


def brute(rows, mu, mu3):
    """Counts of all orders, and each text walked from state to state."""
    c, toks = collections.Counter(), []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        toks.append((i, held, w))
        if not held:
            c.update((x,) for x in w)
            c.update(zip([None, *w[:-1]], w, strict=True))
            c.update(zip([None, *w], w, w[1:], strict=False))
    ones = [x for k, x in c.items() if len(k) == 1]
    n, v, n1, n2 = sum(ones), len(ones), ones.count(1), ones.count(2)
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    def p(*h):
        if len(h) == 1:
            return (c[h] - d) / n if c[h] else d * v / n
        m = mu if len(h) == 2 else mu3
        return (c[h] + m * p(*h[1:])) / (c[h[:-1]] + m)

    def walk(w):
        total, state, last = 0.0, (None,) if c[(None,)] else (), None
        for x in w:
            while state and not c[(*state, x)]:
                m = mu if len(state) == 1 else mu3
                total += math.log10(m / (c[state] + m))
                state = state[1:]
            total += math.log10(p(*state, x))
            state = next((s for s in ((last, x), (x,)) if c[s]), ())
            last = x
        return total

    out = []
    for i, held, w in toks:
        base = sum(math.log10((c[(x,)] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = walk(w)
        out.append((i, held, len(w), sum(c[(x,)] > 0 for x in w), n, base, score, score / len(w)))
    return out


@pytest.mark.parametrize("block_bytes,fan_bits", [(600, 8), (600, 1), (1 << 24, 8)])
def test_matches_brute_force(spark, block_bytes, fan_bits):
    """With a fan of two messages the questions are merged and asked on several times."""
    rng = random.Random(5)
    words = [f"W{k}" for k in range(60)] + ["É", "the", "THE", "a\x0bb"]
    rows = [(k, " ".join(rng.choices(words[: rng.choice([4, 64])], k=rng.randint(0, 40)))) for k in range(120)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (None, "the end"), (3, rows[3][1]), (503, "unseen words only"), (-(2**63), "the end"), (504, "the end " * 3000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string").repartition(4)
    order = lambda r: (-1 if r[0] is None else r[0], r[2], r[5])
    got = sorted(map(tuple, lm_score(df, mu=50.0, mu3=5.0, block_bytes=block_bytes, fan_bits=fan_bits).collect()), key=order)
    want = sorted(brute(rows, 50.0, 5.0), key=order)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-8)


def test_probabilities_of_a_state_sum_to_one(spark):
    """One-word texts: those of all words and of the unknown one share out the start state."""
    rows = [(k, w) for k, w in enumerate("a b a c a b d e f g h i".split()) if zlib.crc32(str(k).encode()) % 10]
    vocabulary = sorted({w for _, w in rows})
    probes = [(k, w) for k, w in zip((x for x in range(10_000, 20_000) if zlib.crc32(str(x).encode()) % 10 == 0), [*vocabulary, "unknown", ""], strict=False)]
    out = lm_score(spark.createDataFrame(rows + probes, "doc_id long, text string"), mu=3.0, mu3=2.0)
    score = {r["doc_id"]: r["score"] for r in out.filter("held_out").collect()}
    n_words, end = len(rows), len(rows)
    c = collections.Counter(w for _, w in rows)
    n, v = n_words + end, len(c) + 1
    n1, n2 = sum(x == 1 for x in [*c.values(), end]), sum(x == 2 for x in [*c.values(), end])
    d = n1 / (n1 + 2 * n2)
    after = {w: math.log10((c[w] + 2.0 * (c[w] + 3.0 * (end - d) / n) / (c[w] + 3.0)) / (c[w] + 2.0)) for w in c} | {"unknown": math.log10((end - d) / n)}
    total = sum(10 ** (score[k] - after[w]) for k, w in probes if w)
    total += 10 ** score[[k for k, w in probes if not w][0]]
    assert v and total == pytest.approx(1.0)


def test_empty(spark):
    assert lm_score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_questions_are_made_and_split_by_one_worker(spark, monkeypatch):
    """A stage of two Python steps holds two workers for each task."""
    from cardamom.llm import lm_scoring as L

    plans, write = [], L.Staged
    monkeypatch.setattr(L, "Staged", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or write(df, name))
    lm_score(spark.createDataFrame([(k, f"a b {k}") for k in range(50)], "doc_id long, text string"))
    assert [p.count("MapInArrow") for name, p in plans if name == "lm-answers"] == [1]
