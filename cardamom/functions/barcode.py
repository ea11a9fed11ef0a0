"""Barcodes: check digits, normal form, and where a record labels one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions import constants as K


def _checked(digits: Column, n: int, odd: int, even: int) -> Column:
    """Whether the last of n digits makes the weighted sum a multiple of ten."""
    number = digits.try_cast("long")
    digit = lambda k: F.call_function("div", number, F.lit(10 ** (n - 1 - k))) % 10
    total = sum((digit(k) * (odd if k % 2 == 0 else even) for k in range(n - 1)), F.lit(0))
    return (F.length(digits) == n) & (F.pmod(F.lit(10) - total % 10, F.lit(10)) == digit(n - 1))


def is_ean13(digits: Column) -> Column:
    return _checked(digits, 13, 1, 3)


def is_ean8(digits: Column) -> Column:
    return _checked(digits, 8, 3, 1)


def normalize_barcode(raw: Column) -> Column:
    """The digits, 12 padded to 13, if they are a valid EAN-13 or EAN-8; else null."""
    digits = F.regexp_replace(raw.cast("string"), "[^0-9]", "")
    padded = lambda d: F.when(F.length(d) == 12, F.concat(F.lit("0"), d)).otherwise(d)
    valid = lambda d: F.when(is_ean13(d) | is_ean8(d), d)
    # each step is computed once, and the code stays small
    return F.get(F.transform(F.transform(F.array(digits), padded), valid), F.lit(0))


def barcode_in_text(text: Column) -> Column:
    """The first valid barcode among the digit runs of a text. Not used on free text by the pipelines."""
    found = F.regexp_extract_all(text, F.lit(r"(?<!\d)(0?87\d{11}|\d{13}|\d{8})(?!\d)"), F.lit(1))
    return F.get(F.filter(F.transform(found, normalize_barcode), lambda x: x.isNotNull()), F.lit(0))


def labelled_barcode(row: Column) -> Column:
    """The first valid barcode of the fields of a VARIANT record that are labelled as one.

    The record itself, then its ``product``, then its ``attributes``; then its lists."""
    maps = F.array(*[F.try_variant_get(row, p, "map<string,string>") for p in ("$", "$.product", "$.attributes")])
    single = F.flatten(F.transform(maps, lambda m: F.array(*[F.try_element_at(m, F.lit(k)) for k in K.BARCODE_FIELDS])))
    lists = [F.coalesce(F.try_variant_get(row, f"$.{k}", "array<variant>"), F.array().cast("array<variant>")) for k in K.BARCODE_LISTS]
    value = lambda v: F.coalesce(F.try_variant_get(v, "$.value", "string"), F.try_variant_get(v, "$", "string"))
    many = F.transform(F.concat(*lists), value)
    return F.get(F.filter(F.transform(F.array_compact(F.concat(single, many)), normalize_barcode), lambda x: x.isNotNull()), F.lit(0))


def card_barcode(ean: Column, gtin: Column, product_ean: Column, scripts: Column) -> Column:
    """The barcode of a product card: its data attributes, else its JSON-LD scripts that are objects."""
    own = F.coalesce(normalize_barcode(product_ean), normalize_barcode(ean), normalize_barcode(gtin))
    found = F.transform(scripts, lambda s: labelled_barcode(F.try_parse_json(s)))
    return F.coalesce(own, F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0)))
