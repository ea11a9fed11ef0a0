"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

#: A word is a run of characters other than ASCII white space.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def free(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def join_spread(left: DataFrame, right: DataFrame, on: list[str], sizes: DataFrame, by: str, most: int = 2_000) -> DataFrame:
    """``left.join(right, on, "left")``, the rows of ``left`` with a key of over ``most`` rows dealt out by the column ``by``.

    sizes: the keys and ``n``, how many rows of ``left`` each has; ``right`` has few rows for a key."""
    hubs = sizes.filter(F.col("n") > most).select(*on, F.ceil(F.col("n") / most).cast("int").alias("_parts"))
    salted = left.join(hubs, on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    each = right.join(hubs, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return salted.join(each, [*on, "_salt"], "left").drop("_salt")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only where the cluster names none (tests, a laptop) a folder is made."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not held:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        held = tempfile.mkdtemp(prefix="cardamom-")
        spark.conf.set("spark.checkpoint.dir", held)
    return held.rstrip("/")


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session's settings are the wanted ones; its own hold again afterwards."""
    conf = spark.conf
    before = {k: conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


#: Settings for a write: its shuffle files go when it is done. Else they stay until the driver happens to collect its
#: garbage, and those of all steps may lie on the executors' disks at once.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Where the shared folder is a local path, Hadoop starts a command (chmod) for each file and folder that it makes, and each child
#: counts with all memory of its JVM until it runs. So there are no files of checksums (Parquet has its own) and no marks of success.
PLAIN = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true", "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def tasks_for(df: DataFrame) -> int:
    """How many tasks write what is made of these rows and no larger than they: one for each piece that Spark would read of
    their estimated size, four for each core at least. Nothing is run for it; rows of unknown size count as endless."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    piece = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return min(max(-(-size // piece), 4 * df.sparkSession.sparkContext.defaultParallelism), 2**31 - 1)


def at_most(df: DataFrame, tasks: int | None) -> DataFrame:
    """The rows, made by so many tasks at most, if a number is given."""
    return df.coalesce(tasks) if tasks else df


class Staged:
    """A table written to the shared folder. It cuts the lineage and outlives executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.name = df.sparkSession, name
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        with settings(self.spark, TIDY):
            df.write.options(compression="zstd", **PLAIN).parquet(self.path)
        self.schema = self.spark.read.parquet(self.path).schema

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; what was read from them and not yet run is lost."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Settings for the join of texts with a table of ids: a Bloom filter of the ids keeps most other texts from being shuffled.
SIFT = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "33554432",
}


def sifted(df: DataFrame, name: str, tasks: int | None = None) -> Staged:
    """The table, written with the settings of SIFT; the session's own hold again afterwards."""
    with settings(df.sparkSession, SIFT):
        return Staged(at_most(df, tasks), name)


@F.arrow_udf(BinaryType())
def deflated(text: pa.Array) -> pa.Array:
    """Texts (or binaries) in fewer bytes, for a shuffle; null stays null."""
    return pa.array([zlib.compress(x.as_buffer()) if x.is_valid else None for x in text], pa.binary())


@F.arrow_udf(StringType())
def inflated(data: pa.Array) -> pa.Array:
    """The texts that ``deflated`` was given."""
    return pa.array([zlib.decompress(x.as_buffer()) if x.is_valid else None for x in data], pa.binary()).cast(pa.string())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows in a batch for Python, unless the session sets another number: texts are long.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application, and make batches small."""
    sc, rows = spark.sparkContext, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":  # Spark's default
        spark.conf.set(rows, BATCH_ROWS)
    if getattr(sc, "_cardamom_sent", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="cardamom-code-")) / "cardamom_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(target))
    sc._cardamom_sent = True
