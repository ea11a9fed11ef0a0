"""Catalog files: JSON arrays (or single objects) to one row for each element, in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.operators.sanitize import PRODUCT

RAW_CARD = {"raw_text": "string", "image": "string", "category": "string", "barcode": "string", "link": "string"}


def scan_files(spark: SparkSession, *paths: str) -> DataFrame:
    """One row for each file, as ``shaped`` gives it."""
    return shaped(spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.unix_seconds("_metadata.file_modification_time").alias("changed_at"), "value"))


def shaped(files: DataFrame) -> DataFrame:
    """Texts of files (path, changed_at in epoch seconds, value) with doc (VARIANT; null if it is no JSON) and kind.

    kind is array, object, other or unreadable."""
    parsed = files.select("path", "changed_at", F.try_parse_json("value").alias("doc"))
    shape = F.schema_of_variant("doc")
    kind = F.when(F.col("doc").isNull(), "unreadable").when(F.startswith(shape, F.lit("ARRAY")), "array").when(F.startswith(shape, F.lit("OBJECT")), "object").otherwise("other")
    return parsed.withColumn("kind", kind)


def elements(files: DataFrame, *, objects: bool = False) -> DataFrame:
    """The elements of array files: path, _ord (place in the file), _row (VARIANT), _is_object.

    With ``objects``, a file that is one object is its own only element; other files have none."""
    kinds = ["array", "object"] if objects else ["array"]
    rows = files.filter(F.col("kind").isin(kinds))
    doc = F.when(F.col("kind") == "array", F.try_variant_get("doc", "$", "array<variant>")).otherwise(F.array("doc"))
    out = rows.select("path", F.posexplode(doc).alias("_ord", "_row"))
    return out.withColumn("_ord", F.col("_ord").cast("long")).withColumn("_is_object", F.coalesce(F.startswith(F.schema_of_variant("_row"), F.lit("OBJECT")), F.lit(False)))


def typed(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The rows with columns for the fields of ``_row``; what does not fit the type is null."""
    return rows.withColumns({k: F.try_variant_get("_row", f"$.{k}", t) for k, t in fields.items()})


def read_catalog(spark: SparkSession, *paths: str) -> DataFrame:
    """Product rows of catalog files; unknown keys stay in ``_row``."""
    return typed(elements(scan_files(spark, *paths)), PRODUCT | {"scrapedAt": "string"})


def read_cards(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw cards of fragment files: arrays extend, objects append, unreadable files are skipped.

    ``_order`` sorts by file, then by the place in it."""
    return cards(scan_files(spark, *paths))


def cards(files: DataFrame) -> DataFrame:
    """The raw cards of scanned fragment files."""
    found = typed(elements(files, objects=True).filter("_is_object"), RAW_CARD)
    return found.withColumn("_order", F.struct("path", "_ord"))


def fragment_counts(files: DataFrame) -> DataFrame:
    """One row: fragment files, and those of them that can be read."""
    return files.agg(F.count("*").alias("files"), F.count_if(F.col("kind").isin("array", "object")).alias("readable"))


def require_fragments(files: DataFrame, least: int) -> None:
    """Raise if fewer files than ``least`` are there, or none has an element."""
    row = fragment_counts(files).first()
    if row["files"] < least:
        raise ValueError(f"{row['files']} fragments; {least} are needed")
    if not row["readable"]:
        raise ValueError("no fragment could be read")


def read_reasons(files: DataFrame) -> DataFrame:
    """(path, count, read_error, changed_at) of catalog files; the error is null for arrays."""
    error = F.when(F.col("kind") == "unreadable", "catalog is unreadable").when(F.col("kind") != "array", "catalog root is not a JSON array")
    n = F.when(F.col("kind") == "array", F.size(F.try_variant_get("doc", "$", "array<variant>"))).otherwise(0)
    return files.select("path", n.cast("long").alias("count"), error.alias("read_error"), "changed_at")


def read_baseline(spark: SparkSession, path: str | None, default_country: str = "nl") -> DataFrame:
    """The last quality report (country, store, total); no path gives an empty one."""
    if path is None:
        return spark.createDataFrame([], "country string, store string, total long")
    return baseline(scan_files(spark, path), default_country)


def baseline(files: DataFrame, default_country: str = "nl") -> DataFrame:
    """The reports of scanned files; those without a store are left out."""
    rows = typed(elements(files), {"country": "string", "store": "string", "total": "long"})
    named = rows.filter(F.coalesce("store", F.lit("")) != "")
    return named.select(F.coalesce(F.nullif("country", F.lit("")), F.lit(default_country)).alias("country"), "store", F.coalesce("total", F.lit(0)).alias("total"))
