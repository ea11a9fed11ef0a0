"""Clean product rows: names, brands, sizes, barcodes, keys; and which rows are no products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import barcode as B
from cardamom.functions import category as C
from cardamom.functions import identity as I
from cardamom.functions.text import blank_to_null, capitals, let, once, strip, strip_promo

#: Columns that a product row has, and their types.
PRODUCT = {"n": "string", "p": "string", "o": "string", "s": "string", "l": "string", "i": "string", "c": "string", "b": "string", "cn": "string", "ik": "string", "bn": "string", "wg": "bigint", "scraped_at": "string"}


def with_product_columns(df: DataFrame) -> DataFrame:
    """The rows with every product column; those that lack are null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in PRODUCT.items() if c not in df.columns})


def classify(df: DataFrame, barcode: Column | None = None) -> DataFrame:
    """The rows with ``_ok`` and the cleaned columns n, cn, ik, bn, wg, s, b.

    Rows that are not ok keep their values. ``barcode`` overrides where the barcode comes from."""
    df = with_product_columns(df)
    code = barcode if barcode is not None else B.labelled_barcode(F.col("_row")) if "_row" in df.columns else F.lit(None).cast("string")
    code = F.coalesce(code, B.normalize_barcode(F.col("b")))
    size = strip(F.coalesce(F.col("s"), F.lit("")))
    facts = F.struct(code.alias("code"), size.alias("size"), F.coalesce(F.col("wg"), I.parse_size(size)).alias("amount"))

    def named(name: Column) -> Column:
        return let(strip_promo(name), lambda clean: let(F.coalesce(blank_to_null(F.col("bn")), I.extract_brand(clean)), lambda brand: branded(name, clean, blank_to_null(F.lower(strip(brand))))))

    def branded(name: Column, clean: Column, brand: Column) -> Column:
        return let(brand, lambda b: let(I.tokens(clean, b), lambda t: let(facts, lambda f: cleaned(name, clean, b, t, f))))

    def cleaned(name: Column, clean: Column, brand: Column, toks: Column, f: Column) -> Column:
        ok = (name != "") & (F.length(clean) >= 3) & I.reject_reason(clean).isNull() & ((F.size(toks) > 0) | brand.isNotNull())
        new = {
            "n": capitals(clean),
            "cn": I.canonical_name(clean, brand, toks),
            "ik": I.identity_key(f["code"], brand, toks, f["amount"]),
            "bn": F.coalesce(brand, F.col("bn")),
            "wg": F.coalesce(f["amount"], F.col("wg")),
            "s": I.size_label(f["size"], f["amount"]),
            "b": F.coalesce(f["code"], F.col("b")),
        }
        return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), *[v.alias(k) for k, v in new.items()])

    rows = once(df, "_new", let(strip(F.coalesce(F.col("n"), F.lit(""))), named))
    value = lambda c: F.when(F.col("_new.ok"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return rows.select(*[value(c) if c in ("n", "cn", "ik", "bn", "wg", "s", "b") else F.col(f"`{c}`") for c in df.columns], F.col("_new.ok").alias("_ok"))


def sanitize(df: DataFrame, barcode: Column | None = None) -> DataFrame:
    """The cleaned rows, without those that are no products."""
    return classify(df, barcode).filter("_ok").drop("_ok")


def rejected(df: DataFrame, barcode: Column | None = None) -> DataFrame:
    """The rows that sanitize drops, as they are."""
    return classify(df, barcode).filter("not _ok").drop("_ok")


def enrich(df: DataFrame) -> DataFrame:
    """Structured rows with category, barcode and cleaned columns.

    The category is the raw one if known, or told from the raw text. Rows that are no
    products stay, not cleaned: a later sanitize drops them."""
    df = with_product_columns(df)
    named = F.coalesce(F.col("raw_text") if "raw_text" in df.columns else F.col("n"), F.lit(""))
    given = blank_to_null(F.col("category")) if "category" in df.columns else F.lit(None).cast("string")
    sources = [B.labelled_barcode(F.col("_row"))] if "_row" in df.columns else []
    sources += [B.normalize_barcode(F.col("barcode"))] if "barcode" in df.columns else []
    code = F.coalesce(*sources, F.lit(None).cast("string"))
    rows = df.withColumns({"c": C.canonical(F.coalesce(given, C.from_name(named))), "b": F.coalesce(code, F.col("b"))})
    return classify(rows, B.normalize_barcode(F.col("b"))).drop("_ok")


def backfill_barcodes(df: DataFrame) -> DataFrame:
    """Rows with b filled from labelled fields where it is empty, and ``_added``."""
    found = F.when(F.coalesce("b", F.lit("")) == "", B.labelled_barcode(F.col("_row")))
    return df.withColumn("_added", found.isNotNull()).withColumn("b", F.coalesce(found, F.col("b")))
