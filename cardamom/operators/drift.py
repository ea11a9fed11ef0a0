"""Counts against a baseline: drop, growth, minimum and age gates; batch-failure gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def against_baseline(targets: DataFrame, counts: DataFrame, baseline: DataFrame, *, by: Sequence[str] = ("country", "store"), baseline_by: Sequence[str] | None = None) -> DataFrame:
    """One row for each target with ``count`` and ``baseline`` (0 if unknown).

    ``baseline_by`` may have fewer columns, such as the store alone."""
    keys = list(baseline_by or by)
    old = baseline.groupBy(*keys).agg(F.max(F.coalesce("total", F.lit(0))).alias("baseline"))
    out = targets.join(counts.select(*by, "count"), list(by), "left").join(old, keys, "left")
    return out.withColumn("count", F.coalesce("count", F.lit(0)).cast("long")).withColumn("baseline", F.coalesce("baseline", F.lit(0)).cast("long"))


def drop_gate(df: DataFrame, *, max_drop: float = 0.5) -> DataFrame:
    """With ``failure``: below the minimum, or else dropped by more than ``max_drop``; null if neither."""
    drop = F.try_divide(F.col("baseline") - F.col("count"), F.col("baseline"))
    label = F.concat(F.upper("country"), F.lit("/"), F.col("store"))
    low = F.concat(label, F.lit(": "), F.col("count"), F.lit(" products < minimum "), F.col("minimum_products"))
    fell = F.concat(label, F.lit(": dropped "), F.rint(drop * 100).cast("long"), F.lit("% vs baseline "), F.col("baseline"), F.lit(" (now "), F.col("count"), F.lit(")"))
    return df.withColumn("failure", F.when(F.col("count") < F.col("minimum_products"), low).when((F.col("baseline") > 0) & (drop > max_drop), fell))


def age_hours(changed_at: Column, now: Column) -> Column:
    """Hours since a time in epoch seconds; infinite if unknown (null or 0)."""
    return F.when(F.coalesce(changed_at, F.lit(0)) != 0, (now - changed_at) / 3600.0).otherwise(F.lit(float("inf")))


def alerts(df: DataFrame, now: Column, *, max_drop: float = 0.5, max_growth: float = 3.0, max_age_hours: float = 72.0) -> DataFrame:
    """With ``age_hours`` and ``alerts``: what is wrong with a catalog, in a fixed order.

    df has count, baseline, minimum_products, read_error (null if none), changed_at (epoch seconds)."""
    age = age_hours(F.col("changed_at"), now)
    n, base = F.col("count"), F.col("baseline")
    state = F.coalesce(
        F.col("read_error"),
        F.when(n == 0, F.lit("catalog contains zero products")),
        F.when(n < F.col("minimum_products"), F.concat(n, F.lit(" products is below configured minimum "), F.col("minimum_products"))),
    )
    fell = F.when((base > 0) & (n < base * (1 - max_drop)), F.concat(F.lit("count dropped from baseline "), base, F.lit(" to "), n, F.lit(f" (limit {max_drop:.0%})")))
    grew = F.when((base > 0) & (n > base * max_growth), F.concat(F.lit("count grew from baseline "), base, F.lit(" to "), n, F.lit(f" (limit {max_growth:g}x)")))
    hours = F.when(age == float("inf"), F.lit("inf")).otherwise(F.call_function("format_number", age, F.lit("0.0")))
    old = F.when(age > max_age_hours, F.concat(F.lit("catalog has not changed for "), hours, F.lit(f"h (limit {max_age_hours:g}h)")))
    return df.withColumn("age_hours", age).withColumn("alerts", F.array_compact(F.array(state, fell, grew, old)))


def annotations(df: DataFrame) -> DataFrame:
    """One line for each alert, in the form that CI services read."""
    text = F.format_string("::error file=%s::%s/%s: %s. Check the store scraper logs and rerun this workflow.", F.col("catalog"), F.col("country"), F.col("store"), F.regexp_replace("alert", "\n", " "))
    return df.withColumn("alert", F.explode("alerts")).select("country", "store", text.alias("annotation"))


def summary(df: DataFrame) -> str:
    """The alerts as a table for a job's summary page; one row for each store, so it is collected."""
    rows = df.select("country", "store", "count", "baseline", F.array_join("alerts", "; ").alias("found")).orderBy("country", "store").collect()
    return "\n".join(["| Catalog | Products | Baseline | Alerts |", "|---|---:|---:|---|", *(f"| {r['country']}/{r['store']} | {r['count']} | {r['baseline']} | {r['found'] or 'none'} |" for r in rows)])


def failure_gate(log: DataFrame, *, max_ratio: float = 0.05) -> DataFrame:
    """One row from a batch log (url, error; error null if fine): counts, ratio, passed."""
    out = log.agg(F.count("*").alias("total"), F.count("error").alias("failed"))
    ratio = F.coalesce(F.try_divide(F.col("failed").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    return out.withColumn("ratio", ratio).withColumn("passed", F.col("ratio") <= max_ratio)


def minimum_gate(df: DataFrame, by: Sequence[str], minimum: int = 1) -> DataFrame:
    """Groups with fewer rows than the minimum."""
    return df.groupBy(*by).agg(F.count("*").alias("count")).filter(F.col("count") < minimum)


def require(df: DataFrame, message: str) -> None:
    """Raise if the frame, one of violations, has rows."""
    first = df.limit(1).collect()
    if first:
        raise ValueError(f"{message}: {first[0].asDict()}")
