"""Mixing sources to target weights by entropy balancing.

Document i of source s gets the rate min(cap, exp(lambda_s * size_i / scale_s)),
which is the least change, in relative entropy, that meets the token target of s.
Newton iterations solve the dual: Spark sums gradient and curvature over a
histogram of (source, size), the driver holds one multiplier for each source (so
the number of sources must suit the driver; nothing grows with documents). Rates
become copies by systematic rounding along the sizes, and each source's rest is
met by changing single copies. Only hashes decide; reruns agree.

Null text has size 0. Null sources are one source, last. Repeated rows count each.
Documents of size 0 get a rate of 1, and an empty table gives an empty result.
Other columns of the input are carried along only if named in ``carry``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, at_most, tasks_for

WEIGHTS = (5.0, 2.0, 1.0)
SALTS = 256
#: Columns of the result; a carried column of such a name gets "c_" before it.
RESERVED = ("doc_id", "size", "source_size", "target", "copies", "taken")


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, cap: float = 3.0) -> dict[str | None, float]:
    """Targets by weight, none above ``cap`` times its size; the excess is shared again by weight."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    weight = {s: float(weights[k % len(weights)]) for k, (s, _) in enumerate(order)}
    most = {s: float(cap * n) for s, n in order}
    total, full = float(sum(n for _, n in order)), set()
    while True:
        left = total - sum(most[s] for s in full)
        free = sum(w for s, w in weight.items() if s not in full)
        level = left / free if free else 0.0
        above = {s for s in weight if s not in full and level * weight[s] > most[s]}
        if not above:
            return {s: most[s] if s in full else level * weight[s] for s in weight}
        full |= above


def solve(cells: DataFrame, target: dict[str, float], cap: float, steps: int = 200) -> dict[str, float]:
    """The multipliers by key: Newton on the dual, kept within a bracket that halves when a step leaves it.

    cells has key, x (scaled size), size, n. Raises if a source is not within a millionth of its target after ``steps``."""
    spark = cells.sparkSession
    lam = dict.fromkeys(target, 0.0)
    low, high = dict.fromkeys(target, -math.inf), dict.fromkeys(target, math.inf)
    for _ in range(steps):
        table = spark.createDataFrame(list(lam.items()), "key string, lam double")
        rate = F.exp(F.least(F.col("lam") * F.col("x"), F.lit(50.0)))
        words = F.col("n") * F.col("size")
        sums = cells.join(table, "key").groupBy("key").agg(F.sum(words * F.least(rate, F.lit(cap))).alias("got"), F.sum(F.when(rate < cap, words * F.col("x") * rate).otherwise(0.0)).alias("slope"))
        done = True
        for r in sums.collect():  # one row a source
            k, gap = r["key"], r["got"] - target[r["key"]]
            if abs(gap) <= 1e-6 * max(1.0, target[k]):
                continue
            done = False
            if gap > 0:
                high[k] = lam[k]
            else:
                low[k] = lam[k]
            step = lam[k] - gap / r["slope"] if r["slope"] > 0 else (lam[k] + 1 if gap < 0 else lam[k] - 1)
            if not low[k] < step < high[k]:
                ends = [v for v in (low[k], high[k]) if math.isfinite(v)]
                step = sum(ends) / 2 if len(ends) == 2 else 2 * lam[k] + math.copysign(1.0, -gap)
            lam[k] = min(1e9, max(-1e9, step))
        if done:
            return lam
    raise RuntimeError(f"no multipliers within a millionth of the targets in {steps} steps")


def mix(df: DataFrame, *, weights=WEIGHTS, cap: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target (of its source), copies, taken, and ``carry``."""
    spark, tasks = df.sparkSession, tasks_for(df)
    src = F.col(source_col).cast("string")
    key = F.when(src.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), src))
    draw = F.xxhash64(F.col(id_col), F.lit(7))
    base = df.select(F.col(id_col).alias("doc_id"), key.alias("key"), size_of(F.col(text_col)).alias("size"), draw.alias("draw"), F.pmod(draw, F.lit(SALTS)).cast("int").alias("salt"), *[F.col(c).alias(f"c_{c}") for c in carry])
    subs = Staged(at_most(base.groupBy("key", "size", "salt").agg(F.count("*").alias("n")), tasks), "mix-subs").read()
    cells = Staged(at_most(subs.groupBy("key", "size").agg(F.sum("n").alias("n")), tasks), "mix-cells").read()
    per = cells.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs")).collect()  # one row a source
    words = {r["key"]: r["words"] for r in per}
    by_name = {(None if k == "-" else k[1:]): k for k in words}
    want = {by_name[s]: t for s, t in targets([(s, words[k]) for s, k in by_name.items()], weights, cap).items()}
    scale = {r["key"]: max(1.0, r["words"] / r["docs"]) for r in per}

    facts = spark.createDataFrame([(k, words[k], want[k], scale[k]) for k in words], "key string, source_size long, target double, scale double")
    cells = cells.join(facts, "key").withColumn("x", F.col("size") / F.col("scale"))
    live = {k: t for k, t in want.items() if 0 < t < cap * words[k]}
    lam = solve(cells.filter("size > 0").select("key", "x", "size", "n"), live, float(cap)) if live else {}
    lam |= {k: 1e9 for k, t in want.items() if t >= cap * words[k] > 0} | {k: -1e9 for k, t in want.items() if t <= 0 < words[k]}
    lams = spark.createDataFrame([(k, lam.get(k, 0.0)) for k in words], "key string, lam double")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("x"), F.lit(50.0)))))
    rated = cells.join(lams, "key").withColumn("mass", F.col("n") * rate)
    along = Window.partitionBy("key").orderBy("size")  # one row for each size that the source has
    end = F.sum("mass").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rated = rated.withColumn("end", end).withColumn("total", (F.floor(F.round(F.col("end"), 6) + 0.5) - F.floor(F.round(F.col("end") - F.col("mass"), 6) + 0.5)).cast("long"))
    rated = rated.withColumn("total", F.greatest(F.lit(0), F.least(F.col("total"), cap * F.col("n"))))
    cells = Staged(at_most(rated.select("key", "size", "n", "total", "source_size", "target"), tasks), "mix-totals").read()

    # What a source lacks or has too much is met by whole copies, the largest that fits each time.
    change: dict[tuple[str, int], int] = {}
    while True:
        moved = spark.createDataFrame([(k, s, c) for (k, s), c in change.items()], "key string, size long, more long")
        now = cells.join(moved, ["key", "size"], "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0)))
        gaps = {r["key"]: want[r["key"]] - r["got"] for r in now.groupBy("key").agg(F.sum(F.col("total") * F.col("size")).alias("got")).collect()}  # one row a source
        table = spark.createDataFrame(list(gaps.items()), "key string, gap double")
        room = F.when(F.col("gap") > 0, cap * F.col("n") - F.col("total")).otherwise(F.col("total"))
        fits = F.struct("size", F.least(room, F.floor(F.abs("gap") / F.col("size"))).cast("long").alias("n"))
        picks = now.join(table, "key").filter((room > 0) & (F.col("size") > 0) & (F.col("size") <= F.abs("gap"))).groupBy("key").agg(F.max(fits).alias("pick")).collect()
        if not picks:
            break
        for r in picks:
            at = (r["key"], r["pick"]["size"])
            change[at] = change.get(at, 0) + r["pick"]["n"] * (1 if gaps[r["key"]] > 0 else -1)
    moved = spark.createDataFrame([(k, s, c) for (k, s), c in change.items()], "key string, size long, more long")
    cells = cells.join(moved, ["key", "size"], "left").withColumn("total", F.col("total") + F.coalesce("more", F.lit(0))).drop("more")

    # A cell's copies are shared among its salts, then among the rows of a salt.
    inside = Window.partitionBy("key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = subs.withColumnRenamed("n", "n_sub").withColumn("upto", F.sum("n_sub").over(inside)).join(cells, ["key", "size"])
    each, extra = F.floor(F.col("total") / F.col("n")), F.col("total") % F.col("n")
    upto = F.expr("(total % n) * upto div n") - F.expr("(total % n) * (upto - n_sub) div n")
    shared = shared.select("key", "size", "salt", each.cast("long").alias("each"), upto.alias("extras"), "source_size", "target")
    rows = base.join(shared, ["key", "size", "salt"])
    rank = F.row_number().over(Window.partitionBy("key", "size", "salt").orderBy("draw", "doc_id"))
    rows = rows.withColumn("copies", F.col("each") + (rank <= F.col("extras")).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *[F.col(f"c_{c}").alias(c if c not in RESERVED else f"c_{c}") for c in carry])
