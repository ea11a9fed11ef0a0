"""Quality counters by store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions.identity import reject_reason
from cardamom.functions.price import is_missing, present

COUNTERS = ("total", "with_barcode", "with_identity", "with_brand", "with_weight", "promo_in_name", "missing_price", "missing_url", "duplicate_identity")


def duplicates(key: Column) -> Column:
    """Aggregate: rows beyond the first of each key; empty keys do not count."""
    key = F.when(present(key), key)
    return (F.count(key) - F.count_distinct(key)).cast("long")


def quality(rows: DataFrame, by: Sequence[str] = ("country", "store"), stores: DataFrame | None = None) -> DataFrame:
    """The counters for each group; with ``stores``, one row for each of its stores, zero if it has none.

    Rows that are no objects (``_is_object`` false) count in the total alone."""
    obj = F.coalesce(F.col("_is_object"), F.lit(True)) if "_is_object" in rows.columns else F.lit(True)
    count = lambda c: F.count_if(obj & c).cast("long")
    out = rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        count(present(F.col("b"))).alias("with_barcode"),
        count(present(F.col("ik"))).alias("with_identity"),
        count(present(F.col("bn"))).alias("with_brand"),
        count(F.coalesce(F.col("wg") != 0, F.lit(False))).alias("with_weight"),
        count(reject_reason(F.col("n")).isNotNull()).alias("promo_in_name"),
        count(is_missing(F.col("p"))).alias("missing_price"),
        count(F.coalesce(F.nullif("l", F.lit("")), F.nullif("i", F.lit(""))).isNull()).alias("missing_url"),
        duplicates(F.when(obj, F.col("ik"))).alias("duplicate_identity"),
    )
    if stores is None:
        return out
    return stores.select(*by).join(out, list(by), "left").fillna(0, list(COUNTERS))


def markdown(report: DataFrame) -> str:
    """The report as a table; one row for each store, so it is collected."""
    head = ["| Country | Store | Total | Barcode | Identity | Brand | Weight | Promo | Dup ik |", "|---------|-------|------:|--------:|---------:|------:|-------:|------:|-------:|"]
    body = [f"| {r['country']} | {r['store']} | {r['total']} | {r['with_barcode']} ({100 * r['with_barcode'] / (r['total'] or 1):.0f}%) | {r['with_identity']} | {r['with_brand']} | {r['with_weight']} | {r['promo_in_name']} | {r['duplicate_identity']} |" for r in report.orderBy("country", "store").collect()]
    return "\n".join(head + body)


def promo_gate(report: DataFrame, store: str = "lidl") -> DataFrame:
    """Reports of a store that has promotional names left: rows are violations."""
    return report.filter((F.col("store") == store) & (F.col("promo_in_name") > 0))
