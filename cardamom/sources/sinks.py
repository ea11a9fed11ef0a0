"""Writers: atomic exports, overwriting what was read, rejects, reports, nested exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _replace(spark: SparkSession, new, target) -> None:
    """Put a file in the place of another in one step, so that one of the two stands there at any time."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, context.makeQualified(target), how)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write to a neighbour and swap, so that ``df`` may read ``path`` itself."""
    spark = df.sparkSession
    staging, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    df.write.format(fmt).save(staging)
    fs, target = _fs(spark, path)
    aside = _fs(spark, old)[1]
    if fs.exists(target):
        fs.rename(target, aside)
    if not fs.rename(_fs(spark, staging)[1], target):
        fs.rename(aside, target)
        raise OSError(f"could not put {path} in place")
    fs.delete(aside, True)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a path if it is there."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def json_lines(df: DataFrame, path: str) -> None:
    """A folder of JSON lines, null fields left out."""
    overwrite(df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")), path, "text")


def json_array(df: DataFrame, path: str, ord_col: str | None = None) -> None:
    """One JSON array in one file, written aside and renamed. For exports that fit one file: the rows go to one task."""
    rows = df.orderBy(ord_col) if ord_col else df
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != ord_col]))
    whole = rows.select(F.col(ord_col).alias("o") if ord_col else F.lit(0).alias("o"), text.alias("t")).groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))), lambda x: x["t"]), ",\n").alias("v"))
    spark, staging = df.sparkSession, f"{path}.{uuid.uuid4().hex}.tmp"
    whole.select(F.concat(F.lit("[\n"), "v", F.lit("\n]")).alias("value")).coalesce(1).write.text(staging)
    fs, folder = _fs(spark, staging)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    _replace(spark, part, _fs(spark, path)[1])
    fs.delete(folder, True)


def with_rejects(classified: DataFrame, kept_path: str, reject_path: str) -> dict[str, int]:
    """Write rows that are ``_ok`` and, aside, the others; no rejects, no file. Returns the counts.

    Rows that are no objects are counted as rejected but not written."""
    obj = F.col("_is_object") if "_is_object" in classified.columns else F.lit(True)
    drop = [c for c in ("_ok", "_is_object") if c in classified.columns]
    n = classified.agg(F.count("*").alias("input"), F.count_if(F.col("_ok")).alias("kept"), F.count_if(~F.col("_ok") & obj).alias("written")).first()
    bad = classified.filter(~F.col("_ok") & obj).drop(*drop)
    if n["written"]:
        json_lines(bad, reject_path)
    else:
        remove(classified.sparkSession, reject_path)
    json_lines(classified.filter("_ok").drop(*drop), kept_path)
    return {"input": n["input"], "kept": n["kept"], "rejected": n["input"] - n["kept"]}
