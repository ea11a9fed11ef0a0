import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cardamom.llm.suffix_dedup import remove_repeats


def covered(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        yield t, gone


def brute(texts, length=400, passage=256):
    shared = [int(g.sum()) for _, g in covered(texts, passage)]
    out = []
    for (t, gone), n in zip(covered(texts, length), shared, strict=True):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest(), n))
    return out


COLS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"]


def check(spark, rows):
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).toPandas()
    key = lambda r: (-1 if r[0] is None or r[0] != r[0] else r[0], r[1:])
    got = sorted(out[COLS].itertuples(index=False, name=None), key=key)
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute([(t or "").encode() for _, t in rows]), strict=True)), key=key)
    assert [r[1:] for r in got] == [r[1:] for r in want]
    assert all(hashlib.sha256(bytes(k)).hexdigest() == h for k, h in zip(out.kept, out.kept_sha256, strict=True))


@pytest.mark.parametrize("seed,ranges", [(1, 4), (2, 4), (3, 40)])
def test_matches_brute_force(spark, seed, ranges):
    """With many ranges most intervals lie at an edge."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("ab c", k=3000)) for _ in range(3)]
    rows = []
    for i in range(40):
        s = ""
        for _ in range(rng.randint(1, 5)):
            a = rng.randint(0, 2500)
            s += rng.choice(base)[a : a + rng.randint(0, 900)] if rng.random() < 0.6 else "".join(rng.choices("abcdé", k=rng.randint(0, 500)))
        rows.append((i, s))
    rows += [(100, "a" * 5000), (101, "of " * 300), (102, None), (103, ""), (104, "x" * 399), (105, "y" * 400), (106, "z" * 401), (107, "q w" * 500 + "k" * 450), (108, rows[0][1]), (108, rows[0][1]), (None, base[0][:450]), (109, "\0" * 300), (110, "v" * 255), (111, "u" * 257)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false" if ranges > 4 else "true")
    try:
        check(spark, rows)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_one_passage_in_very_many_contexts(spark):
    rng = random.Random(9)
    words = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = words(450)
    check(spark, [(i, words(rng.randint(0, 60)) + passage[rng.randint(0, 30) :] + words(rng.randint(0, 300))) for i in range(150)])


def test_empty_table_and_clashes(spark):
    df = spark.createDataFrame([(1, "x", 2, b"k")], "doc_id long, text string, n_bytes int, kept binary")
    assert remove_repeats(df).first()["n_removed"] == 0
    assert remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(df, passage=100)
