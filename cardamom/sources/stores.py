"""The store dimension: one row for each country and store of a configuration file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STORE = "struct<display_name:string,dir:string,catalog:string,minimum_products:int,pipeline:array<string>,intermediate_globs:array<string>,playwright:boolean>"
_COUNTRY = f"struct<label:string,locale:string,currency:string,stores:map<string,{_STORE}>>"
CONFIG = f"struct<default_country:string,countries:map<string,{_COUNTRY}>>"


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return store_rows(spark.read.text(path, wholetext=True))


def store_rows(texts: DataFrame) -> DataFrame:
    """The stores of configurations as JSON texts (value)."""
    doc = texts.select(F.from_json("value", CONFIG).alias("c"))
    countries = doc.select("c.default_country", F.explode("c.countries").alias("country", "v"))
    stores = countries.select("default_country", "country", "v.label", "v.locale", "v.currency", F.posexplode(F.map_entries("v.stores")).alias("_store_ord", "e"))
    out = stores.select("country", "label", "locale", "currency", F.col("e.key").alias("store"), "e.value.*", "_store_ord", (F.col("country") == F.col("default_country")).alias("is_default"))
    return out.withColumn("minimum_products", F.coalesce("minimum_products", F.lit(0))).withColumn("catalog_path", catalog_path(F.col("dir"), F.col("catalog")))


def catalog_path(directory: Column, catalog: Column) -> Column:
    return F.concat_ws("/", directory, catalog)


def select(stores: DataFrame, country: str | None = None, store: str | None = None) -> DataFrame:
    """Stores of a country (the default one, if none is named), maybe one alone."""
    out = stores.filter(F.col("country") == country) if country else stores.filter("is_default")
    return out.filter(F.col("store") == store) if store else out


def one_store(stores: DataFrame, country: str, store: str) -> dict:
    row = stores.filter((F.col("country") == country) & (F.col("store") == store)).first()
    if row is None:
        raise KeyError(f"unknown store {country}/{store}")
    return row.asDict(recursive=True)


def countries(stores: DataFrame) -> list[str]:
    return [r["country"] for r in stores.select("country").distinct().orderBy("country").collect()]


def intermediate_globs(stores: DataFrame) -> DataFrame:
    """(country, store, glob): the patterns of files that a pipeline leaves behind."""
    return stores.select("country", "store", F.explode("intermediate_globs").alias("g")).select("country", "store", F.col("g").alias("glob"))


def seed_urls(spark: SparkSession, seeds: dict[str, list[str]]) -> DataFrame:
    """(store, url, _ord) of lists of URLs by store."""
    return spark.createDataFrame([(s, u, k) for s, urls in seeds.items() for k, u in enumerate(urls)], "store string, url string, _ord int")
