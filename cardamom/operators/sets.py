"""Splits, unions and differences that keep an order column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardamom.functions.text import holds_any


def split_by_keywords(df: DataFrame, text_col: str, keywords: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose text holds a keyword (as it is written), and the others."""
    hit = F.coalesce(holds_any(F.col(text_col), keywords), F.lit(False))
    return df.filter(hit), df.filter(~hit)


def union_branches(*branches: DataFrame, branch_col: str = "_branch") -> DataFrame:
    """All rows, each with the number of its branch; columns that a branch lacks are null."""
    out = branches[0].withColumn(branch_col, F.lit(0))
    for k, b in enumerate(branches[1:], 1):
        out = out.unionByName(b.withColumn(branch_col, F.lit(k)), allowMissingColumns=True)
    return out


def removable_paths(candidates: DataFrame, canonical: DataFrame, path_col: str = "path") -> DataFrame:
    """Distinct candidate paths that are not canonical, sorted."""
    return candidates.select(path_col).distinct().join(canonical.select(path_col), path_col, "left_anti").orderBy(path_col)


def name_starts_offer(df: DataFrame, offer_col: str = "o", name_col: str = "n") -> DataFrame:
    """Rows whose offer starts with the name (an empty name starts all)."""
    return df.filter(F.startswith(F.coalesce(offer_col, F.lit("")), F.coalesce(name_col, F.lit(""))))


def page_rows(df: DataFrame, by: Sequence[str], ord_col: str, per_page: int, pages: int) -> DataFrame:
    """The rows that a listing with so many pages of so many rows would show for each group."""
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(*by).orderBy(ord_col))).filter(F.col("_at") <= per_page * pages).drop("_at")


def expand_cache(urls: DataFrame, cached: DataFrame) -> DataFrame:
    """Rows cached under a target URL, once for each source URL that leads to it, with its category."""
    return urls.select("source_url", "target_url", F.col("category").alias("_category")).join(cached, "target_url").withColumn("category", F.col("_category")).drop("_category")


def nested(df: DataFrame, by: Sequence[str], ord_col: str, out_col: str = "d") -> DataFrame:
    """One row for each group with an array of its rows in order. A group is one value: for exports, not hot keys."""
    rest = [c for c in df.columns if c not in by and c != ord_col]
    rows = F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("_ord"), F.struct(*rest).alias("row"))))
    return df.groupBy(*by).agg(F.transform(rows, lambda x: x["row"]).alias(out_col))
