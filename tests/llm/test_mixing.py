import random

import pytest
from pyspark.sql import functions as F

from cardamom.llm.mixing import mix, solve, targets


def test_targets():
    assert targets([("a", 100), ("b", 100), ("c", 100), (None, 100)]) == pytest.approx({"a": 2000 / 13, "b": 800 / 13, "c": 400 / 13, None: 2000 / 13})
    capped = targets([("a", 10), ("b", 100), ("c", 190)])
    assert capped == pytest.approx({"a": 30, "b": 180, "c": 90})
    assert targets([]) == {} and targets([("a", 0)]) == {"a": 0}
    assert sum(targets([("é", 5), ("z", 50), ("A", 500), ("b", 1)]).values()) == pytest.approx(556)


def rows(n=600):
    rng = random.Random(1)
    out = [(k, "w " * rng.choice([0, 1, 3, 10, 40, 200]), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for k in range(n)]
    return out + [(9000, None, "s1"), (9001, "", "s9"), (9002, "x y z", "s8"), (5, out[5][1], out[5][2])]


def test_mix(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, s, 7) for i, t, s in data], "doc_id long, text string, source string, size int")
    out = mix(df, carry=("text", "size")).collect()
    assert len(out) == len(data)
    sums, goal = {}, {}
    for r in out:
        n = len((r["text"] or "").split())
        assert r["size"] == n and r["c_size"] == 7 and 0 <= r["copies"] <= 3 and r["taken"] == n * r["copies"]
        sums[r["target"], r["source_size"]] = sums.get((r["target"], r["source_size"]), 0) + r["taken"]
    for (target, size), taken in sums.items():
        assert abs(taken - target) <= max(2, 0.02 * target) or size < 50
    goal = targets([(s, sum(len((t or "").split()) for _, t, x in data if x == s)) for s in {s for *_, s in data}])
    assert {round(t, 6) for t, _ in sums} == {round(t, 6) for t in goal.values()}


def test_multipliers_solve_the_dual(spark):
    """Against bisection of each source alone; and no answer where there is none."""
    import math

    rng = random.Random(2)
    sizes = {s: [rng.choice([1, 2, 7, 30, 300]) for _ in range(200)] for s in ("a", "b", "c")}
    share = {"a": 0.4, "b": 1.7, "c": 2.9}
    scale = {s: sum(v) / len(v) for s, v in sizes.items()}
    want = {s: share[s] * sum(v) for s, v in sizes.items()}
    cells = [(s, n / scale[s], n, v.count(n)) for s, v in sizes.items() for n in set(v)]
    df = spark.createDataFrame(cells, "key string, x double, size long, n long")
    got = solve(df, want, 3.0)
    for s in sizes:
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            words = sum(n * min(3.0, math.exp(mid * n / scale[s])) for n in sizes[s])
            low, high = (mid, high) if words < want[s] else (low, mid)
        assert got[s] == pytest.approx(low, abs=1e-4)
    with pytest.raises(RuntimeError):
        solve(df, want, 3.0, steps=1)


def test_long_text_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "w " * 200_000, "a", "x", 1), (2, "v", "a", "y", 2)], "doc_id long, text string, source string, key string, salt int")
    out = {r["doc_id"]: r for r in mix(df, carry=("key", "salt")).collect()}
    assert out[1]["size"] == 200_000 and out[1]["key"] == "x" and out[2]["salt"] == 2


def test_reruns_agree_whatever_the_partitions(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    one = sorted(map(tuple, mix(df).collect()))
    assert one == sorted(map(tuple, mix(df.repartition(7, F.rand(3))).collect()))


def test_one_cell_with_most_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 10, "b").otherwise("a").alias("source"))
    got = {r["source_size"]: (r["target"], r["taken"]) for r in mix(df).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    assert got[30][1] == 90 and abs(got[8970][1] - got[8970][0]) <= 3


def test_empty(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
