"""Health of catalogs: metrics, ordered issues, status, and the report over all stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardamom.functions import constants as K
from cardamom.functions.barcode import normalize_barcode
from cardamom.functions.identity import reject_reason
from cardamom.functions.price import is_suspicious, present, rate, strict_price
from cardamom.functions.text import once, strip

ISSUE = "struct<severity:string,code:string,actual:double,threshold:double>"


def scrape_time(*values: Column) -> Column:
    """The first non-empty value as a time in UTC; null if it is none. Values without a zone are UTC."""
    text = F.coalesce(*[F.nullif(v, F.lit("")) for v in values])
    return F.try_to_timestamp(text)


def metrics(rows: DataFrame, now: Column, *, by: Sequence[str] = ("country", "store"), stale_hours: float = K.HEALTH["stale_after_hours"]) -> DataFrame:
    """One row for each group with all counters and rates. ``rows`` has ik, b, p, n, scraped (a timestamp).

    Barcodes and identities are first summed by (group, barcode, identity), so conflicts and
    duplicates need no second look at the rows."""
    obj = F.coalesce(F.col("_is_object"), F.lit(True)) if "_is_object" in rows.columns else F.lit(True)
    facts = F.struct(normalize_barcode(F.col("b")).alias("code"), strict_price(F.col("p")).alias("price"))
    code, price = F.col("_facts.code"), F.col("_facts.price")
    prepared = once(rows, "_facts", facts).select(
        *by,
        obj.alias("obj"),
        F.when(obj, F.nullif(strip(F.coalesce("ik", F.lit(""))), F.lit(""))).alias("ik"),
        F.when(obj, code).alias("code"),
        (obj & present(F.col("b")) & code.isNull()).alias("bad_code"),
        (obj & price.isNull()).alias("bad_price"),
        F.coalesce(obj & is_suspicious(price, *K.PRICE_RANGE), F.lit(False)).alias("odd_price"),
        (obj & reject_reason(F.col("n")).isNotNull()).alias("promo"),
        F.when(obj, F.col("scraped")).alias("scraped"),
    )
    late = F.unix_micros(now) - F.unix_micros("scraped") > int(stale_hours * 3600 * 1_000_000)
    n = lambda c: F.sum(c.cast("long"))
    pairs = prepared.groupBy(*by, "code", "ik").agg(
        F.count("*").alias("rows"), n(F.col("obj")).alias("objs"), n(F.col("bad_code")).alias("bad_code"), n(F.col("bad_price")).alias("bad_price"), n(F.col("odd_price")).alias("odd_price"), n(F.col("promo")).alias("promo"),
        n(F.col("obj") & F.col("scraped").isNull()).alias("no_time"), n(F.coalesce(late, F.lit(False))).alias("late"), F.max("scraped").alias("newest"),
    )
    # Identities of one barcode; rows without a barcode are spread by their identity.
    spread = F.when(F.col("code").isNull(), F.xxhash64("ik"))
    pairs = pairs.withColumn("iks", F.count("ik").over(Window.partitionBy(*by, "code", spread)))
    coded, named = F.col("code").isNotNull(), F.col("ik").isNotNull()
    out = pairs.groupBy(*by).agg(
        F.sum("rows").alias("product_count"), (F.sum("rows") - F.sum("objs")).alias("malformed_rows"), F.sum("bad_code").alias("invalid_barcodes"), F.sum("bad_price").alias("invalid_prices"), F.sum("odd_price").alias("suspicious_prices"),
        F.sum("promo").alias("promo_in_name"), F.sum("no_time").alias("missing_timestamps"), F.sum("late").alias("stale_rows"), F.max("newest").alias("newest_at"),
        F.coalesce(F.sum(F.when(coded, F.col("rows"))), F.lit(0)).alias("valid_barcodes"), F.coalesce(F.sum(F.when(named, F.col("rows"))), F.lit(0)).alias("identities"),
        F.count_distinct("code").alias("_codes"), F.count_distinct("ik").alias("_iks"), F.count_distinct(F.when(coded & (F.col("iks") > 1), F.col("code"))).alias("conflicts"),
    )
    out = out.withColumns({"duplicate_barcodes": F.col("valid_barcodes") - F.col("_codes"), "duplicate_identities": F.col("identities") - F.col("_iks")}).drop("_codes", "_iks")
    total = F.col("product_count")
    shares = {"barcode_coverage": "valid_barcodes", "invalid_price_rate": "invalid_prices", "suspicious_price_rate": "suspicious_prices", "duplicate_identity_rate": "duplicate_identities", "duplicate_barcode_rate": "duplicate_barcodes"}
    return out.withColumns({k: rate(F.col(v), total) for k, v in shares.items()})


def issues(m: DataFrame, *, minimum: Column | None = None, coverage_floor: Column | None = None, limits: dict = K.HEALTH) -> DataFrame:
    """The metrics with ``issues`` (in a fixed order) and ``status``: error, warning or pass."""
    minimum = F.lit(0) if minimum is None else minimum
    floor = F.lit(limits["minimum_barcode_coverage"]) if coverage_floor is None else coverage_floor
    c = F.col
    found = lambda when, severity, code, actual, limit: F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), actual.cast("double").alias("actual"), (limit if isinstance(limit, Column) else F.lit(limit)).cast("double").alias("threshold")))
    over = lambda name, limit: c(name) > limits[limit]
    junk = c("malformed_rows") + c("promo_in_name")
    rows = [
        found(c("product_count") < minimum, "error", "product_count_below_minimum", c("product_count"), minimum),
        F.coalesce(
            found(over("invalid_price_rate", "max_invalid_price_rate"), "error", "invalid_price_rate_high", c("invalid_price_rate"), limits["max_invalid_price_rate"]),
            found(over("invalid_price_rate", "warn_invalid_price_rate"), "warning", "invalid_price_rate_elevated", c("invalid_price_rate"), limits["warn_invalid_price_rate"]),
        ),
        found(over("suspicious_price_rate", "max_suspicious_price_rate"), "warning", "suspicious_price_rate_high", c("suspicious_price_rate"), limits["max_suspicious_price_rate"]),
        found(over("duplicate_identity_rate", "max_duplicate_identity_rate"), "error", "duplicate_identity_rate_high", c("duplicate_identity_rate"), limits["max_duplicate_identity_rate"]),
        found(over("duplicate_barcode_rate", "max_duplicate_barcode_rate"), "warning", "duplicate_barcode_rate_high", c("duplicate_barcode_rate"), limits["max_duplicate_barcode_rate"]),
        found(c("conflicts") > 0, "warning", "barcode_identity_conflicts", c("conflicts"), 0),
        found(c("barcode_coverage") < floor, "error", "barcode_coverage_below_minimum", c("barcode_coverage"), floor),
        found(c("invalid_barcodes") > 0, "warning", "invalid_barcodes", c("invalid_barcodes"), 0),
        found(c("missing_timestamps") > 0, "warning", "missing_scrape_timestamps", c("missing_timestamps"), 0),
        found(c("stale_rows") > 0, "error", "stale_scrape_rows", c("stale_rows"), 0),
        found(junk > 0, "warning", "malformed_or_rejected_rows", junk, 0),
    ]
    return with_status(m.withColumn("issues", F.array_compact(F.array(*rows))))


def with_status(df: DataFrame) -> DataFrame:
    worst = F.when(F.exists("issues", lambda i: i["severity"] == "error"), F.lit("error")).when(F.size("issues") > 0, F.lit("warning")).otherwise(F.lit("pass"))
    return df.withColumn("status", worst)


def structural_issues(stores: DataFrame, reasons: DataFrame, by: Sequence[str] = ("country", "store")) -> DataFrame:
    """Stores whose catalog is missing, unreadable or no array (``reason``), as reports with that one error."""
    one = F.array(F.struct(F.lit("error").alias("severity"), F.col("reason").alias("code"), F.lit(None).cast("double").alias("actual"), F.lit(None).cast("double").alias("threshold")))
    return with_status(stores.select(*by).join(reasons, list(by)).filter("reason is not null").withColumn("issues", one))


def rollup(health: DataFrame) -> DataFrame:
    """One row over all stores: counts by status, products, barcodes and the worst status."""
    count = lambda s: F.count_if(F.col("status") == s).cast("long").alias(s)
    worst = F.when(F.bool_or(F.col("status") == "error"), F.lit("error")).when(F.bool_or(F.col("status") == "warning"), F.lit("warning")).otherwise(F.lit("pass"))
    return health.agg(F.count("*").alias("stores"), count("pass"), count("warning"), count("error"), F.coalesce(F.sum("product_count"), F.lit(0)).alias("products"), F.coalesce(F.sum("valid_barcodes"), F.lit(0)).alias("barcodes"), worst.alias("status"))


def table(health: DataFrame) -> str:
    """The reports as lines for a terminal; one row for each store, so it is collected."""
    rows = health.select("country", "store", "status", "product_count", F.format_string("%.1f%%", F.col("barcode_coverage") * 100).alias("coverage"), F.array_join(F.transform("issues", lambda i: i["code"]), ", ").alias("codes")).orderBy("country", "store").collect()
    lines = [("STORE", "STATUS", "PRODUCTS", "BARCODES", "ISSUES")] + [(f"{r['country']}/{r['store']}", r["status"], str(r["product_count"]), r["coverage"], r["codes"]) for r in rows]
    wide = [max(len(x[k]) for x in lines) for k in range(4)]
    return "\n".join("  ".join([*(v.ljust(w) for v, w in zip(x, wide, strict=False)), x[4]]).rstrip() for x in lines)


def exit_code(status: str, fail_on: str = "error") -> int:
    return int(status in {"error": ("error",), "warning": ("error", "warning"), "never": ()}[fail_on])
