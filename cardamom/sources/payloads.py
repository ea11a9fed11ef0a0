"""Landed API payloads to raw cards. All functions read a VARIANT column of one product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import price as P
from cardamom.functions.barcode import labelled_barcode
from cardamom.functions.text import blank_to_null, strip


def _text(row: Column, path: str) -> Column:
    return F.try_variant_get(row, path, "string")


def _number(row: Column, path: str) -> Column:
    return F.try_variant_get(row, path, "double")


def _stripped(row: Column, path: str) -> Column:
    return strip(F.coalesce(_text(row, path), F.lit("")))


def _titled(brand: Column, name: Column) -> Column:
    return F.when(brand != "", strip(F.concat(brand, F.lit(" "), name))).otherwise(name)


def _money(x: Column) -> Column:
    return F.replace(P.two_decimals(x), F.lit("."), F.lit(","))


def _card(lines: list[Column], image: Column, barcode: Column | None = None, link: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    text = F.array_join(F.array_compact(F.array(*lines)), "\n")
    return F.struct(text.alias("raw_text"), image.alias("image"), (null if barcode is None else barcode).alias("barcode"), (null if link is None else link).alias("link"))


def ah_card(row: Column) -> Column:
    """Brand and title, the bonus line, the current price (or the one before the bonus), the unit."""
    now, before = _number(row, "$.currentPrice"), _number(row, "$.priceBeforeBonus")
    mechanism, unit = _stripped(row, "$.bonusMechanism"), _stripped(row, "$.salesUnitSize")
    bonus = F.when(mechanism != "", mechanism).when(F.coalesce(before, F.lit(0.0)) != 0, F.concat(F.lit("van "), _money(before)))
    price = F.when(F.coalesce(now, F.lit(0.0)) != 0, now).otherwise(before)
    lines = [_titled(_stripped(row, "$.brand"), _stripped(row, "$.title")), F.when(F.try_variant_get(row, "$.isBonus", "boolean"), bonus), _money(price), blank_to_null(unit)]
    image = F.coalesce(blank_to_null(_text(row, "$.images[0].url")), _text(row, "$.images[0].href"), F.when(F.schema_of_variant(F.try_variant_get(row, "$.images[0]", "variant")) == "STRING", _text(row, "$.images[0]")))
    return _card(lines, image, labelled_barcode(row))


def ah_child_ids(payload: Column) -> Column:
    """Ids of the options of the first filter that is the taxonomy."""
    filters = F.coalesce(F.try_variant_get(payload, "$.filters", "array<variant>"), F.array().cast("array<variant>"))
    first = F.get(F.filter(filters, lambda f: _text(f, "$.id") == "taxonomy"), F.lit(0))
    options = F.coalesce(F.try_variant_get(first, "$.options", "array<variant>"), F.array().cast("array<variant>"))
    return F.filter(F.transform(options, lambda o: _text(o, "$.id")), lambda x: F.coalesce(x, F.lit("")) != "")


def jumbo_card(row: Column) -> Column:
    """Title, the first tag of the first promotion, the price from cents (a promotion's counts even if 0)."""
    tag = F.try_variant_get(row, "$.promotions[0].tags[0].text", "variant")
    text = F.when(F.schema_of_variant(tag) == "STRING", blank_to_null(_text(row, "$.promotions[0].tags[0].text")))
    cents = F.coalesce(_number(row, "$.prices.promoPrice"), _number(row, "$.prices.price"))
    return _card([_stripped(row, "$.title"), text, blank_to_null(P.cents_line(cents))], _text(row, "$.image"), None, _text(row, "$.link"))


def plus_card(row: Column, origin: str) -> Column:
    """Brand and name, subtitle, the new price or the original one; a link from the slug."""
    price = F.coalesce(blank_to_null(P.comma_price(_text(row, "$.NewPrice"))), P.comma_price(_text(row, "$.OriginalPrice")))
    lines = [blank_to_null(_titled(_stripped(row, "$.Brand"), _stripped(row, "$.Name"))), blank_to_null(_stripped(row, "$.Product_Subtitle")), blank_to_null(price)]
    link = F.concat(F.lit(f"{origin}/producten/"), blank_to_null(_text(row, "$.Slug")))
    return _card(lines, _text(row, "$.ImageURL"), labelled_barcode(row), link)


def plus_products(payloads: DataFrame, payload_col: str, origin: str) -> DataFrame:
    """Cards of all products of PLUS payloads, without those that have no text."""
    rows = payloads.withColumn("_item", F.explode(F.try_variant_get(payload_col, "$.ProductList.List", "array<variant>")))
    rows = rows.withColumn("_item", F.coalesce(F.try_variant_get("_item", "$.PLP_Str", "variant"), F.col("_item")))
    rows = rows.filter(F.startswith(F.schema_of_variant("_item"), F.lit("OBJECT")))
    return rows.withColumn("_card", plus_card(F.col("_item"), origin)).select(*payloads.columns, "_card.*").filter("raw_text <> ''")


def card_identity(link: Column, raw_text: Column) -> Column:
    return F.coalesce(blank_to_null(link), raw_text, F.lit(""))
