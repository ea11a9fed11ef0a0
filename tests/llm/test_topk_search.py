import numpy as np
from pyspark.sql import functions as F

from cardamom.llm.topk_search import topk_search


def test_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(900, 8)).astype(np.float32)
    v[10] = v[20] = v[30]  # ties
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = sorted(map(tuple, topk_search(df, F.col("vec_id") % 10 == 0).collect()))
    e = np.floor(v.astype(float) * 1024).astype(np.int64)
    want = []
    for q in range(0, 900, 10):
        s = e @ e[q]
        order = [j for j in np.lexsort((np.arange(900), -s)) if j != q][:10]
        want += [(q, k + 1, int(j), int(s[j])) for k, j in enumerate(order)]
    assert got == sorted(want)


def test_several_groups_and_chunks(spark):
    """Blocks of clusters, so that bounds rule some out, in many groups; the same results."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 6)) * 20
    v = (centres[np.repeat(np.arange(30), 40)] + rng.normal(size=(1200, 6))).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<float>").repartitionByRange(6, "vec_id")
    got = sorted(map(tuple, topk_search(df, F.col("vec_id") % 4 == 0, k=7, first=1, group_blocks=2, block_rows=20).collect()))
    e = np.floor(v.astype(float) * 1024).astype(np.int64)
    want = []
    for q in range(0, 1200, 4):
        s = e @ e[q]
        want += [(q, k + 1, int(j), int(s[j])) for k, j in enumerate([j for j in np.lexsort((np.arange(1200), -s)) if j != q][:7])]
    assert got == sorted(want)


def test_odd_vectors(spark):
    rows = [(0, [1e30, 2.0]), (100, [1e30, -3.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, []), (7, [5.0]), (200, []), (None, [1.0, 1.0]), (8, [float("inf"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = sorted(map(tuple, topk_search(df, F.col("vec_id") % 100 == 0).collect()))
    assert got == [(0, 1, 100, 2**63 - 1), (100, 1, 0, 2**63 - 1), (200, 1, 6, 0)]
    assert topk_search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search(df, F.col("vec_id") == 0).collect()))
    assert got == [(0, 1, 1, 2048 * 1024)] * 2 + [(0, 2, 1, 2048 * 1024)] * 2
