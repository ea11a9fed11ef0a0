"""Raw cards to product columns: one parser for each store's layout.

A parser takes the raw text (and image) and returns a struct of n (name), p (price),
o (offer), s (size) and l (image), all strings, none null. Missing texts are empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import constants as K
from cardamom.functions import price as P
from cardamom.functions import text as T

_NUMBER = r"\d+([.,]?\d+)?\s?"
UNIT_AH = rf"(?iUd)\b{_NUMBER}(g|kg|ml|l|cl|stuks?|stuk\(s\)|x\s?\d+.*)\b"
UNIT_JUMBO = rf"(?iUd)\b{_NUMBER}(g|kg|ml|l|cl|stuks?|x\s?\d+.*)\b"
UNIT_DIRK = rf"(?iU)^\s*{_NUMBER}(g|kg|ml|l|liter|cl|stuks?|x)\s*$"
UNIT_DIRK_PROMO = rf"(?iUd)^{_NUMBER}(g|kg|ml|l|liter|cl|stuks?|x.*)$"
UNIT_PLUS = r"(?iUd)\b(per\s*)?\d+\s?(g|kg|ml|l|cl|stuks?|x\s?\d+.*|st|gram)\b"
SIZE_LIDL = r"(?iUd)\b(per\s+\w+|\d+\s*[xX]\s*\d+\s*(?:g|kg|ml|l|cl|stuks?)|\d+\s?(g|kg|ml|l|cl|x\s?\d+.*|stuks?))"


def _first(array: Column) -> Column:
    return F.coalesce(F.get(array, F.lit(0)), F.lit(""))


def _joined(array: Column) -> Column:
    return F.array_join(array, " ")


def _product(n, p, o, s, image: Column) -> Column:
    filled = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(filled(n).alias("n"), filled(p).alias("p"), filled(o).alias("o"), filled(s).alias("s"), filled(image).alias("l"))


def _first_size(lines: Column, unit: str) -> Column:
    """The first match of the unit pattern in the first line that has one."""
    return _first(F.filter(F.transform(lines, lambda x: F.regexp_extract(x, unit, 0)), lambda x: x != ""))


def _lowest(prices: Column) -> Column:
    return F.coalesce(P.two_decimals(F.array_min(P.as_numbers(prices))), F.lit(""))


def _without(array: Column, drop: Column) -> Column:
    return F.filter(array, lambda x: ~F.array_contains(drop, x))


def _leading_digits(lines: Column) -> Column:
    """How many lines at the start are digits alone."""
    at = F.array_position(F.transform(lines, lambda x: x.rlike(r"(?U)^\d+$")), F.lit(False))
    return F.when(at == 0, F.size(lines)).otherwise(at - 1).cast("int")


def _from(array: Column, start: Column) -> Column:
    return F.filter(array, lambda x, i: i >= start)


def _upto(array: Column, end: Column) -> Column:
    return F.filter(array, lambda x, i: i < end)


def parse_ah(raw: Column, image: Column) -> Column:
    """Offer lines hold a keyword; the price that is not the offer's is the regular one."""

    def of(lines: Column) -> Column:
        is_offer = lambda x: T.holds_any(F.lower(x), K.OFFERS_AH)
        offers = F.filter(lines, is_offer)
        priced = F.filter(F.transform(offers, P.prices_in), lambda x: F.size(x) > 0)
        offer_price = F.replace(F.get(F.try_element_at(priced, F.lit(-1)), F.lit(0)), F.lit(","), F.lit("."))
        price_only = lambda x: x.rlike(r"(?U)^\d+[.,]\d{2}$")
        size_only = lambda x: x.rlike(rf"(?iUd)^{UNIT_AH[6:]}") & ~F.translate(x, "gkmlxstuc()", "").rlike(r"\p{L}")
        name = _first(F.filter(lines, lambda x: ~is_offer(x) & ~price_only(x) & ~size_only(x)))

        def price(found: Column) -> Column:
            pointed = F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit(".")))
            rest = F.get(F.filter(pointed, lambda x: x != offer_price), F.lit(0))
            return (
                F.when((F.size(found) >= 2) & offer_price.isNotNull(), rest)
                .when((F.size(found) == 1) & offer_price.isNull(), F.get(pointed, F.lit(0)))
                .when((F.size(found) >= 1) & offer_price.isNull(), P.two_decimals(F.array_max(P.as_numbers(found))))
            )

        picture = F.when(image == K.NO_IMAGE, F.lit("")).otherwise(image)
        return _product(name, T.let(P.prices_in(raw), price), _joined(offers), _first_size(lines, UNIT_AH), picture)

    return T.let(T.lines(raw), of)


def parse_coop(raw: Column, image: Column) -> Column:
    """The same layout as parse_ah's."""
    return parse_ah(raw, image)


def parse_jumbo(raw: Column, image: Column) -> Column:
    """The first line without its last five characters; the lowest price; offers by whole words."""

    def of(lines: Column) -> Column:
        first = _first(lines)
        n = F.length(first)
        # a negative end counts from the end once more: four characters leave three, three leave one
        end = F.when(n >= 5, n - 5).otherwise(F.greatest(F.lit(0), 2 * n - 5))
        offer = F.filter(lines, lambda x: F.lower(x).rlike(rf"(?U)\b(?:{T.quoted(K.OFFERS_JUMBO)})\b"))
        return _product(F.substring(first, F.lit(1), end), _lowest(P.prices_in(raw)), _joined(offer), _first_size(lines, UNIT_JUMBO), image)

    return T.let(T.lines(raw), of)


def parse_aldi(raw: Column, image: Column) -> Column:
    """The offer line starts with a keyword; the name is the longest of the lines that are left."""

    def of(all_lines: Column) -> Column:
        offers = F.transform(all_lines, lambda x: T.starts_any(F.lower(x), K.OFFERS_ALDI))
        at = F.array_position(offers, F.lit(True))
        offer = F.when(at > 0, F.get(all_lines, (at - 1).cast("int")))

        def rest(lines: Column) -> Column:
            price = F.get(F.filter(lines, lambda x: x.rlike(r"(?U)^\d+\.\d{2}$")), F.lit(0))
            live = F.filter(lines, lambda x: ~F.coalesce(x == price, F.lit(False)) & ~F.contains(x, F.lit("=")))
            named = lambda x: F.startswith(F.lower(x), F.lit("inhoud:"))
            sized = F.filter(live, lambda x: named(x) | (T.holds_any(F.lower(x), K.SIZES_ALDI) & x.rlike(r"(?U)\d")))
            size = F.get(F.transform(sized, lambda x: F.when(named(x), T.strip(F.replace(F.lower(x), F.lit("inhoud:"), F.lit("")))).otherwise(x)), F.lit(0))
            fit = F.filter(live, lambda x: (F.length(x) > 2) & ~T.holds_any(F.lower(x), ("boodschappenlijstje", "inhoud")) & ~F.lower(x).isin(*K.BRANDS_ALDI))

            def name(names: Column) -> Column:
                long = F.filter(F.transform(names, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x"))), lambda y: y["n"] > 5)
                return F.coalesce(F.array_max(long)["x"], F.get(names, F.lit(0)))

            return _product(T.let(F.array_distinct(fit), name), price, offer, size, image)

        return T.let(F.filter(all_lines, lambda x, i: i != F.coalesce(at, F.lit(0)) - 1), rest)

    return T.let(T.lines(raw), of)


def parse_dirk(raw: Column, image: Column) -> Column:
    """Digits first make the price; then one size line, one offer line, and the name."""

    def of(lines: Column) -> Column:
        k = _leading_digits(lines)
        price = F.array_join(_upto(lines, k), ".")

        def rest(left: Column) -> Column:
            size_at = F.array_position(F.transform(left, lambda x: x.rlike(UNIT_DIRK)), F.lit(True)) - 1
            offer = F.transform(left, lambda x, i: (i != size_at) & T.holds_any(F.lower(x), K.OFFERS_DIRK))
            offer_at = F.array_position(offer, F.lit(True)) - 1
            name = F.filter(left, lambda x, i: (i != size_at) & (i != offer_at))
            at = lambda i: F.when(i >= 0, F.get(left, i.cast("int")))
            return _product(_joined(name), price, at(offer_at), at(size_at), image)

        return T.let(_from(lines, k), rest)

    return T.let(T.all_lines(raw), of)


def parse_dirk_promo(raw: Column, image: Column) -> Column:
    """Every keyword line is the offer and goes wherever it stands; one price part is cents."""

    def of(all_lines: Column) -> Column:
        offers = F.filter(all_lines, lambda x: T.holds_any(F.lower(x), K.OFFERS_DIRK_PROMO))

        def rest(lines: Column) -> Column:
            k = _leading_digits(lines)
            parts = _upto(lines, k)
            price = F.when(k == 2, F.array_join(parts, ".")).when(k == 1, F.concat(F.lit("0."), F.get(parts, F.lit(0))))

            def last(left: Column) -> Column:
                at = F.array_position(F.transform(left, lambda x: x.rlike(UNIT_DIRK_PROMO)), F.lit(True)) - 1
                size = F.when(at >= 0, F.get(left, at.cast("int")))
                return _product(T.strip(_joined(F.filter(left, lambda x, i: i != at))), price, _joined(offers), size, image)

            return T.let(_from(lines, k), last)

        return T.let(_without(all_lines, offers), rest)

    return T.let(T.lines(raw), of)


def parse_lidl(raw: Column, image: Column) -> Column:
    """The name is what is left of the text without prices, offer, size, keywords, dates and marks."""

    def of(lines: Column) -> Column:
        full = _joined(lines)
        offer = _joined(F.filter(lines, lambda x: T.holds_any(F.lower(x), K.OFFERS_LIDL)))
        prices = P.prices_in(full)
        size = F.regexp_replace(T.strip(F.regexp_extract(full, SIZE_LIDL, 0)), rf"(?U){T.SPACE}+", " ")
        size = F.upper(F.regexp_replace(size, r"([0-9])([xX])([0-9])", "$1 x $3"))
        drop = F.filter(F.concat(prices, F.array(offer, size)), lambda x: x != "")
        name = F.aggregate(drop, full, lambda a, x: F.replace(a, x, F.lit("")))
        for k in K.OFFERS_LIDL:
            name = F.regexp_replace(name, rf"(?iU)\b{T.quoted([k])}\b", "")
        for p in K.NOTES_LIDL:
            name = F.regexp_replace(name, f"(?iUd){p}", "")
        name = F.regexp_replace(name, r"(?U)[-−]?[€Є]\d+\.?-?", "")
        name = T.collapse(F.regexp_replace(name, r"(?iU)\bRAM\b", ""))
        low = lambda w: F.transform(w, F.lower)
        once = T.let(T.words(name), lambda w: _joined(F.filter(w, lambda x, i: F.array_position(low(w), F.lower(x)) == i + 1)))
        return _product(once, _lowest(prices), T.strip(offer), size, image)

    return T.let(T.lines(raw), of)


def parse_plus(raw: Column, image: Column) -> Column:
    """Offer lines first, if any, then the name and its size; the price of all text without spaces."""

    def of(lines: Column) -> Column:
        is_offer = F.transform(lines, lambda x: T.holds_any(F.lower(x), K.OFFERS_PLUS))
        gap = F.array_position(is_offer, F.lit(False))
        k = F.when(gap == 0, F.size(lines)).otherwise(gap - 1).cast("int")
        bare = lambda x: F.regexp_replace(T.strip(F.regexp_replace(x, UNIT_PLUS, "")), rf"(?U){T.SPACE}+", " ")
        size = F.when(k > 0, F.regexp_extract(F.get(lines, k + 1), UNIT_PLUS, 0)).otherwise(_first_size(lines, UNIT_PLUS))
        packed = F.replace(F.regexp_replace(_joined(lines), rf"(?U){T.SPACE}+", ""), F.lit(","), F.lit("."))
        found = F.regexp_extract_all(packed, F.lit(r"(?U)\d+\.\d{2}"), F.lit(0))
        cents = F.regexp_extract_all(packed, F.lit(r"(?U)\b\d{3}\b"), F.lit(0))
        cents = F.transform(cents, lambda x: F.concat(F.substring(x, 1, 1), F.lit("."), F.substring(x, 2, 2)))
        price = F.when(F.size(found) > 0, _lowest(found)).otherwise(_lowest(cents))
        return _product(bare(F.get(lines, k)), price, _joined(_upto(lines, k)), size, image)

    return T.let(T.lines(raw), of)


LAYOUTS = {
    "albert-heijn": parse_ah,
    "coop": parse_coop,
    "jumbo": parse_jumbo,
    "aldi": parse_aldi,
    "dirk": parse_dirk,
    "dirk-promo": parse_dirk_promo,
    "lidl": parse_lidl,
    "plus": parse_plus,
}


def parse_cards(cards: DataFrame, layout: str, *, text_col: str = "raw_text", image_col: str = "image") -> DataFrame:
    """The cards with n, p, o, s and l (columns of these names are replaced)."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    parsed = T.once(cards, "_parsed", LAYOUTS[layout](raw, F.coalesce(F.col(image_col), F.lit(""))))
    return parsed.withColumns({c: F.col(f"_parsed.{c}") for c in "nposl"}).drop("_parsed")
