"""Duplicates: keep the best or the first row of each key.

Keys are hashed to 128 bits and only what decides is aggregated: fixed-width buffers, so hash
aggregations with partial sums, and a hot key is combined before the shuffle. Whole rows are not
moved into a group; those that won are told by their key and position in a semi join. The
position must tell the rows of one key apart; that of a key's first row is kept for ordered export.
The input is read twice: write an expensive one down first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions.price import loose_price
from cardamom.functions.text import blank_to_null, strip


def first_key(keys: Sequence[str | Column]) -> Column:
    """The first of the keys that is neither null nor empty."""
    return F.coalesce(*[blank_to_null((F.col(k) if isinstance(k, str) else k).cast("string")) for k in keys])


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("_k1"), F.xxhash64(F.lit(1), key).alias("_k2")]


def _keep(df: DataFrame, key: Column, best: Column | None, ord_col: str, first_ord: str | None) -> DataFrame:
    """The row of least ``best`` (if given), then of the least position, for each key that is not null."""
    k = ["_k1", "_k2"]
    facts = df.filter(key.isNotNull()).select(*_hashed(key), F.col(ord_col).alias("_o"), *([best.alias("_b")] if best is not None else []))
    if best is None:
        won = facts.groupBy(*k).agg(F.min("_o").alias("_first")).withColumn("_at", F.col("_first"))
    else:
        each = facts.groupBy(*k, "_b").agg(F.min("_o").alias("_o"))  # no ties are left in a key
        won = each.groupBy(*k).agg(F.coalesce(F.min_by("_o", "_b"), F.min("_o")).alias("_at"), F.min("_o").alias("_first"))
    won = won.select(F.col("_k1").alias("_w1"), F.col("_k2").alias("_w2"), "_at", "_first")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.filter(key.isNotNull()).select(*_hashed(key), F.col(ord_col).alias("_o"), whole.alias("_whole"))
    kept = rows.join(won, (F.col("_k1") == F.col("_w1")) & (F.col("_k2") == F.col("_w2")) & (F.col("_o") == F.col("_at")))
    return kept.select("_whole.*", *([F.col("_first").alias(first_ord)] if first_ord else []))


def keep_best(df: DataFrame, keys: Sequence[str | Column], best: Column, ord_col: str, first_ord: str | None = None) -> DataFrame:
    """The row of least ``best`` (null last) for each key, the earliest on ties; rows without a key go.

    ``first_ord`` names a column for the position of the key's first row."""
    return _keep(df, first_key(keys), best, ord_col, first_ord)


def keep_cheapest(df: DataFrame, *, price_col: str = "p", ord_col: str = "_ord", keys: Sequence[str] = ("ik", "cn", "n"), within: Sequence[str] = ()) -> DataFrame:
    """The cheapest product of each identity (and of ``within``, e.g. a store)."""
    key = F.when(first_key(keys).isNotNull(), F.to_json(F.struct(*[F.col(c) for c in within], first_key(keys).alias("_k"))))
    return keep_best(df, [key], loose_price(F.col(price_col)), ord_col, "_first_ord")


def removed_count(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """One row: rows with a key, distinct keys, and their difference."""
    counted = df.select(first_key(keys).alias("_key")).filter("_key is not null").groupBy("_key").agg(F.count("*").alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("keyed"), F.count("*").alias("kept")).withColumn("removed", F.col("keyed") - F.col("kept"))


def keep_first(df: DataFrame, keys: Sequence[str | Column], ord_col: str) -> DataFrame:
    """The earliest row for each key; all of ``keys`` together are the key, and none may be null."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    ok = cols[0].isNotNull()
    for c in cols[1:]:
        ok = ok & c.isNotNull()
    key = F.when(ok, F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])))
    return _keep(df, key, None, ord_col, None)


def keep_first_name(df: DataFrame, *, name_col: str = "n", ord_col: str = "_ord", enabled: bool = True) -> DataFrame:
    """The first row of each stripped name; nameless rows go. ``enabled=False`` returns all rows."""
    return keep_first(df, [blank_to_null(strip(F.col(name_col)))], ord_col) if enabled else df


def keep_first_id(df: DataFrame, *, ord_col: str = "_ord", row_col: str = "_row") -> DataFrame:
    """The first record of each id, webshopId or, without them, JSON text of a VARIANT column."""
    field = lambda k: blank_to_null(F.try_variant_get(F.col(row_col), f"$.{k}", "string"))
    return keep_first(df, [F.coalesce(field("id"), field("webshopId"), F.to_json(row_col))], ord_col)
