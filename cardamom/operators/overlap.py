"""Rows of one catalog that another has too: anti and semi joins on several keys.

A disjunction of equalities would be a nested loop; here each key is a join of its
own. Empty keys match nothing, and rows with them are spread, not sent to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("ik", "b", "cn")


def without_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``left`` that share none of the keys with any row of ``right``."""
    for k in keys:
        known = right.select(F.col(k).alias("_known")).filter("_known is not null and _known <> ''").distinct()
        own = F.col(k).cast("string")
        # U+0000 begins no key of the right side
        spread = F.when(F.coalesce(own, F.lit("")) == "", F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if c != "_row"]).cast("string"))).otherwise(own)
        left = left.withColumn("_own", spread).join(known, F.col("_own") == F.col("_known"), "left_anti").drop("_own")
    return left


def overlap(left: DataFrame, right: DataFrame, id_col: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``left`` that share a key with ``right``, told by ``id_col``: the complement of the above."""
    pairs = lambda df, *more: df.select(*more, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("value")) for k in keys])).alias("pair")).filter("pair.value is not null and pair.value <> ''")
    hit = pairs(left, id_col).join(pairs(right).distinct(), "pair", "left_semi").select(F.col(id_col).alias("_hit")).distinct()
    return left.join(hit, F.col(id_col) == F.col("_hit"), "left_semi")


def overlap_stats(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> dict[str, int]:
    """Counts before and after; all zero if a side is missing (None)."""
    if left is None or right is None:
        return {"right": 0, "before": 0, "after": 0, "removed": 0}
    before, after = left.count(), without_overlap(left, right, keys).count()
    return {"right": right.count(), "before": before, "after": after, "removed": before - after}
