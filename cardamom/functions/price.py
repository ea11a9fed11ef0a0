"""Price columns: three readings of a price, and price formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions.text import blank_to_null, first_match, strip


def loose_price(p: Column) -> Column:
    """The first number in the text; infinity if there is none. This one orders duplicates."""
    number = first_match(F.replace(strip(p), F.lit(","), F.lit(".")), r"(?U)\d+(?:\.\d+)?")
    return F.coalesce(number.try_cast("double"), F.lit(float("inf")))


def strict_price(p: Column) -> Column:
    """The number that the whole text is, if positive and finite; else null. This one judges health."""
    text = F.replace(strip(p), F.lit(","), F.lit("."))
    value = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    return F.when((value > 0) & (value < float("inf")), value)


def is_missing(p: Column) -> Column:
    return F.coalesce(strip(p), F.lit("")).isin("", "0", "0.0", "0.00")


def is_suspicious(price: Column, low: float, high: float) -> Column:
    return (price < low) | (price > high)


def two_decimals(x: Column) -> Column:
    """Two decimals, rounded as C and Python do."""
    return F.call_function("format_number", x, F.lit("0.00"))


def whole_to_cents(p: Column) -> Column:
    """Digits alone are cents: 85 is 0.85, 5 is 0.05 (and 199 is 0.199)."""
    return F.when(p.rlike("^[0-9]+$"), F.concat(F.lit("0."), F.lpad(p, F.greatest(F.lit(2), F.length(p)), F.lit("0")))).otherwise(p)


def cents_line(cents: Column) -> Column:
    """A price line from cents; empty from null."""
    return F.coalesce(F.concat(F.lit("Prijs: € "), F.replace(two_decimals(cents.cast("double") / 100.0), F.lit("."), F.lit(","))), F.lit(""))


def comma_price(value: Column) -> Column:
    """A price text with a decimal comma; nothing from null, empty and zero."""
    text = F.replace(value, F.lit("."), F.lit(","))
    out = F.when(text.rlike("^[0-9]+$"), F.concat(text, F.lit(",00"))).otherwise(text)
    return F.when(value.isNull() | value.isin("", "0", "0.0"), F.lit("")).otherwise(out)


def prices_in(text: Column) -> Column:
    """All texts that look like prices: digits, a point or comma, two digits."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\d+[.,]\d{2}"), F.lit(0))


def as_numbers(prices: Column) -> Column:
    return F.transform(prices, lambda p: F.replace(p, F.lit(","), F.lit(".")).try_cast("double"))


def rate(part: Column, whole: Column) -> Column:
    """A share with six decimals; 0 of nothing."""
    return F.coalesce(F.round(F.try_divide(part.cast("double"), whole.cast("double")), 6), F.lit(0.0))


def present(c: Column) -> Column:
    return blank_to_null(c).isNotNull()
