import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardamom.llm import simhash as S
from cardamom.llm.components import components


def plain(text, width=4):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    votes = np.zeros(64)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        votes += [(h >> j) & 1 for j in range(64)]
    return sum(1 << j for j in range(64) if 2 * votes[j] > len(shingles))


def groups(values, limit):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= limit:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_fingerprint():
    for t in (None, "", "  ", "One", "a b c", "A b C d", "a b c d e\x0bf\tg é", "x " * 500, "É Ü   k"):
        assert S.fingerprint(t) == plain(t)


def test_groups_match_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(30):
        t = rng.choices(words, k=80)
        for _ in range(rng.randint(1, 6)):
            u = list(t)
            for _ in range(rng.randint(0, 2)):
                u[rng.randrange(80)] = rng.choice(words)
            rows.append((len(rows) * 3, " ".join(u)))
    rows += [(5000, None), (4999, ""), (4998, " \n"), (0, rows[0][1]), (6000, "tiny"), (7000, rows[0][1] + " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    values = [plain(t) for _, t in rows]
    root = groups(values, 4)
    least = {r: min(i for (i, _), x in zip(rows, root, strict=True) if x == r) for r in set(root)}
    want = sorted((i, format(v, "016x"), least[r]) for (i, _), v, r in zip(rows, values, root, strict=True))
    assert sorted(map(tuple, S.simhash_groups(df).collect())) == want
    assert S.simhash_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [7, 4096])
def test_links_for_all_thresholds(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, np.uint64)
    near = [x ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for x in base for _ in range(5)]
    values = sorted({int(x) for x in [*base, *near]})
    nodes = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    for limit in (2, 4, 7):
        got = dict(components(S.near_links(nodes, limit, block)).collect())
        root = groups(values, limit)
        signed = [int(np.uint64(v).view(np.int64)) for v in values]
        same = {}
        for s, r in zip(signed, root, strict=True):
            same.setdefault(r, []).append(s)
        for group in same.values():
            assert len({got.get(s, s) for s in group}) == 1


def test_allocation_sums_to_the_limit():
    flat = np.full((64, 64), 0.25) + np.eye(64) * 0.25
    for n in (10, 10**5, 10**9):
        for limit in (0, 3, 4, 8):
            parts, t = S.allocate(n, flat * n, limit)
            assert sum(x + 1 for x in t) == limit + 1 and sorted(j for p in parts for j in p) == list(range(64))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (7, 6), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1300)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_groups_are_verified(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    base = rng.choices(words, k=200)
    near, far = list(base), list(base)
    near[100] = "changed"  # 10 of 201 shingles differ
    for k in range(0, 200, 12):
        far[k] = "other"  # most shingles differ
    rows = [(4, " ".join(base)), (2, " ".join(near)), (9, " ".join(far)), (7, None), (8, ""), (5, " ".join(base)), (None, " ".join(base)), (3, "x y")]
    got = {r["doc_id"]: r["component_id"] for r in S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {4: 2, 2: 2, 5: 2, None: 2, 9: 9, 7: 7, 8: 7, 3: 3}
    pairs = S._forest(np.arange(3000, dtype=np.uint64), 12)
    assert len(pairs) == 2999
    assert len(S._forest(np.array([0, 1, 3, 1 << 40, (1 << 40) + 7], np.uint64), 2)) == 4


def jaccard_groups(rows, similarity=0.8, width=5):
    """{doc_id: least doc_id of its group}, all pairs compared."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return {i: least[root(k)] for k, (i, _) in enumerate(rows)}


def test_similar_groups_match_all_pairs(spark):
    """Hubs whose variants are unlike each other, groups of near copies and pairs around the limit."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(600)]
    rows = []

    def changed(t, count, at=0):
        u = list(t)
        for k in range(count):
            u[(at + 12 * k) % len(u)] = f"new{rng.random()}"
        return u

    for _ in range(3):
        hub = rng.choices(words, k=240)
        rows.append(hub)
        rows += [changed(hub, 4, 17 * v) for v in range(40)]  # 0.85 to the hub, 0.7 or so to each other
    for _ in range(40):
        base = rng.choices(words, k=150)
        rows += [base, changed(base, rng.randint(1, 5), rng.randrange(150))]
    dense = rng.choices(words, k=200)
    rows += [changed(dense, 1, k) for k in range(150)]
    rng.shuffle(rows)
    rows = [(k, " ".join(t)) for k, t in enumerate(rows)]
    got = dict(map(tuple, S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == jaccard_groups(rows)


def test_equal_fingerprints_are_verified(spark):
    """Unlike texts with one fingerprint, as a repeated passage outvotes their own words, stay apart."""
    rng = random.Random(13)
    passage = [f"p{k}" for k in range(9)]
    rows = []
    for k in range(12):
        own = [f"own{rng.randrange(10**9)}" for _ in range(600)]
        rows.append((k, " ".join(own + passage * (7 * len(own) // 27))))
    rows += [(100 + k, t) for k, t in rows[:2]]
    assert len({S.fingerprint(t) for _, t in rows}) == 1
    got = dict(map(tuple, S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == {k: k % 100 for k, _ in rows} == jaccard_groups(rows)


def test_one_of_each_keeps_unlike_texts_under_one_id(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(1, a, 5), (1, b, 6), (1, a, 5), (2, a, 7), (None, b, 8), (None, c, 9), (3, None, 1), (4, "", 2), (5, "x y " * 30_000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int").withColumnRenamed("node", "_node")
    out = S.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["_node"]) for r in out.collect()) == sorted([(1, a, 5), (1, b, 6), (0, c, 9), (3, "", 1), (5, "x y " * 30_000, 3)])
    assert S.one_of_each(df.limit(0)).count() == 0


def test_recall_by_similarity(spark):
    """All pairs are found in each band of similarity from 0.8 on, and none below."""
    rng = random.Random(12)
    rows, wanted = [], {}
    for k in range(120):
        n = rng.randint(60, 300)
        a = [f"v{rng.randrange(4000)}" for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(1, max(1, n // 30))):
            b[rng.randrange(n)] = f"z{rng.randrange(10**6)}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        x, y = (S._shingles(t, 5) for _, t in rows[-2:])
        wanted[k] = len(x & y) / len(x | y)
    got = dict(map(tuple, S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    bands = {}
    for k, s in wanted.items():
        bands.setdefault(int(s * 20), []).append(got[2 * k + 1] == 2 * k)
    assert all(all(v) if band >= 16 else not any(v) for band, v in bands.items()) and {16, 17, 18} <= set(bands)


def test_neighbours_in_one_shingle_alone_are_left_for_the_last_step(spark):
    rows = [(t, 1, 10, 0, 2, 10, 0) for t in (7, 8)] + [(9, 1, 10, 1, 3, 10, 1)]
    df = spark.createDataFrame(rows, "token long, node long, size int, pos int, n_node long, n_size int, n_pos int")
    assert [tuple(r) for r in S._pairs(df, 0.8).collect()] == [(1, 2)]


def test_few_of_many_texts_are_sifted_before_they_are_shuffled(spark, monkeypatch):
    from cardamom.llm import _common

    docs = spark.range(20_000).select(F.col("id").alias("node"), F.concat(F.lit("one two three four five six seven eight "), F.col("id").cast("string")).alias("text"))
    docs = _common.Staged(docs, "texts").read()
    links = spark.createDataFrame([(1, 2), (3, 19_999), (5, 5_000_000)], "a long, b long")
    plans, write = [], _common.Staged
    monkeypatch.setattr(_common, "Staged", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    before, most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {tuple(r) for r in S.similar_links(links, docs, 5, 0.6).read().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {(1, 2), (3, 19_999)}
    assert len(plans) == 1 and "might_contain" in plans[0]
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits", None) == most


def variants(rng, count, changes):
    """Texts that share shingles with many others and are mostly unlike each other, and near copies of some."""
    words = [f"w{k}" for k in range(600)]
    hub, rows = rng.choices(words, k=120), []
    for v in range(count):
        t = list(hub)
        for k in range(changes):
            t[(v * 7 + 17 * k) % len(t)] = f"new{rng.random()}"
        rows.append(t)
        if v % 5 == 0:
            rows.append([*t, "end"])
    return [(k, " ".join(t)) for k, t in enumerate(rows)]


@pytest.mark.parametrize("block,few", [(1 << 20, 50), (3_000, 8)])
def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch, block, few):
    """Variants of one hub: all pairs are compared, but only rows in proportion to the texts are made."""
    made, write = [], S.Staged

    class Counted(write):
        def __init__(self, df, name):
            super().__init__(df, name)
            if name in ("near-links", "other-links", "similar-links", "family-links"):
                made.append(self.read().count())

    monkeypatch.setattr(S, "Staged", Counted)
    monkeypatch.setattr(S, "BLOCK_SHINGLES", block, raising=False)
    monkeypatch.setattr(S, "FEW", few, raising=False)
    rows = variants(random.Random(2), 150, 4)
    got = dict(map(tuple, S.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == jaccard_groups(rows) and 1 < len(set(got.values())) < len(rows)
    assert max(made) < 10 * len(rows)


@pytest.mark.parametrize("two", [False, True])
def test_forest_of_sets_matches_all_pairs(two):
    rng = np.random.default_rng(6)
    sets = []
    for n in [1, 1, 2, 5, 9, 30, 31, 60, 100, 127, 128, 400, 3000, 9000]:
        base = rng.integers(0, 2**63, n, np.uint64)
        for changed in (0, 0.04, 0.1, 0.12, 0.3):
            x = base.copy()
            x[: int(n * changed)] = rng.integers(0, 2**63, int(n * changed), np.uint64)
            sets.append(np.unique(x))
    side = rng.integers(0, 2, len(sets)) if two else np.zeros(len(sets), int)
    start = np.arange(len(sets))
    start[1] = 0

    def joined(links):
        parent = start.tolist()
        for _ in parent:
            for x, y in links:
                parent[x] = parent[y] = min(parent[x], parent[y])
            parent[1] = parent[0] = min(parent[:2])
        return parent

    want = [(i, j) for i in range(len(sets)) for j in range(i) if (not two or side[i] != side[j]) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    got = S._similar_forest(sets, start, side, 0.8)
    assert joined(got) == joined(want) and {tuple(sorted(x)) for x in got} <= {tuple(sorted(x)) for x in want} and 0 < len(got) < len(sets)


def test_shingles_of_many_texts_are_known_as_common(spark):
    """Passages that 125 of 5,000 texts have: the sample grows with the input, so they are known to be common."""
    passage = lambda k: " ".join(f"p{k}w{j}" for j in range(12))
    rows = [(i, passage(i % 40) + " " + " ".join(f"u{i}v{j}" for j in range(20))) for i in range(5_000)]
    hashes, counts = S.common_shingles(spark.createDataFrame(rows, "node long, text string"), 5, sample=50)
    of = np.unique(np.concatenate([S._set_hashes(passage(k), 5) for k in range(40)]))
    assert np.isin(of, hashes).mean() > 0.9 and len(counts) == len(hashes)


def test_few_edges_in_many_pieces_are_joined_in_one_task(spark):
    from unittest import mock

    from cardamom.llm import components as C

    edges = [(k, k + 7) for k in range(700)] + [(5_000, 3), (5_001, 5_000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(8, "a", "b")
    want = {k: k % 7 for k in range(707)} | {5_000: 3, 5_001: 3}
    for last, tables in ((C.LAST, range(2, 3)), (0, range(3, 60))):
        made = []
        with mock.patch.object(C, "LAST", last), mock.patch.object(C, "Staged", lambda *a, f=C.Staged: made.append(a) or f(*a)), mock.patch.object(C, "_contracted", lambda e, f=C._contracted: f(e.repartition(8, "a", "b") if not made else e)):
            assert {r["node"]: r["component"] for r in C.components(df).collect()} == want
        assert len(made) in tables
