"""Names, sizes, brands, tokens and identity keys of products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions import constants as K
from cardamom.functions.price import two_decimals
from cardamom.functions.text import collapse, first_match, words


def reject_reason(name: Column) -> Column:
    """Why a name is no product: too short, or the first pattern that it matches; else null."""
    n = collapse(F.coalesce(name, F.lit("")))
    out = F.when(F.length(n) < 3, F.lit("name_too_short"))
    for p in K.REJECT_PATTERNS:
        out = out.when(n.rlike(f"(?iUd){p}"), F.lit(f"reject_pattern:{p[:40]}"))
    return out


_N = r"(\d+(?:\.\d+)?)"


def parse_size(size: Column) -> Column:
    """A size as one whole number: millilitres, grams or pieces; null if there is none."""
    low = F.regexp_replace(F.replace(F.lower(size), F.lit(","), F.lit(".")), rf"(?U)^per\s+", "")
    whole = lambda x: F.rint(x).try_cast("long")
    multi = rf"(?U)(\d+)\s*[x×]\s*{_N}\s*(ml|l|g|kg)\b"
    number = lambda p, g=1: first_match(low, p, g).try_cast("double")
    times = F.when(first_match(low, multi, 3).isin("l", "kg"), F.lit(1000.0)).otherwise(F.lit(1.0))
    return F.coalesce(
        whole(number(multi, 1) * number(multi, 2) * times),
        whole(number(rf"(?U){_N}\s*ml\b")),
        whole(number(rf"(?U){_N}\s*l(?:iter)?(?!\w)") * 1000),
        whole(number(rf"(?U){_N}\s*g(?:ram)?(?!\w)")),
        whole(number(rf"(?U){_N}\s*kg\b") * 1000),
        first_match(low, r"(?U)(\d+)\s*st(?:uk)?(?:s)?\b", 1).try_cast("long"),
        F.when(low.isin("stuk", "st", "st.", "per stuk"), F.lit(1).cast("long")),
    )


def size_label(size: Column, amount: Column) -> Column:
    text = (
        F.when((amount >= 1000) & (amount % 1000 == 0), F.concat((amount / 1000).cast("long").cast("string"), F.lit(" l")))
        .when(amount >= 1000, F.replace(F.concat(two_decimals(amount / 1000), F.lit(" l")), F.lit(".00"), F.lit("")))
        .when(amount == 1, F.lit("1 stuk"))
        .otherwise(F.concat(amount.cast("string"), F.lit(" ml")))
    )
    plain = collapse(F.when(F.coalesce(size, F.lit("")) == "", F.lit("stuk")).otherwise(size))
    return F.when(amount.isNotNull(), text).otherwise(plain)


def extract_brand(name: Column) -> Column:
    """A brand phrase, else the first known brand, else the first word with a capital and three letters."""
    low = F.lower(name)
    phrase = None
    for p in K.PHRASE_BRANDS:
        hit = F.contains(low, F.lit(p))
        phrase = F.when(hit, F.lit(p)) if phrase is None else phrase.when(hit, F.lit(p))
    known = F.get(F.filter(F.regexp_extract_all(low, F.lit("[a-z0-9&]+"), F.lit(0)), lambda t: t.isin(*K.BRANDS)), F.lit(0))
    letters = F.transform(words(name), lambda w: F.regexp_replace(w, "[^a-zA-Z&]", ""))
    capital = F.filter(letters, lambda w: (F.length(w) >= 3) & w.rlike("^[A-Z]") & ~F.lower(w).isin(*K.STOP_WORDS))
    return F.coalesce(phrase, known, F.lower(F.get(capital, F.lit(0))))


def tokens(name: Column, brand: Column) -> Column:
    """The distinct words of a name, sorted, without its brand, sizes, stop words and store words."""
    parts = words(F.lower(F.coalesce(brand, F.lit(""))))
    bare = F.aggregate(parts, F.lower(name), lambda a, b: F.regexp_replace(a, F.concat(F.lit(r"(?U)\b\Q"), b, F.lit(r"\E\b")), F.lit(" ")))
    bare = F.regexp_replace(bare, r"(?U)\d+(?:[.,]\d+)?\s*(ml|l|cl|g|kg|stuks?|st)\b", " ")
    found = F.regexp_extract_all(bare, F.lit("[a-z0-9]+"), F.lit(0))
    kept = F.filter(found, lambda t: (F.length(t) >= 2) & ~t.isin(*K.STOP_WORDS, *K.STORE_TOKENS))
    return F.array_sort(F.array_distinct(kept))


def canonical_name(name: Column, brand: Column, toks: Column) -> Column:
    joined = F.array_join(toks, " ")
    return F.when((F.size(toks) > 0) & brand.isNotNull(), F.concat(brand, F.lit(" "), joined)).when(F.size(toks) > 0, joined).otherwise(F.lower(collapse(name)))


def identity_key(barcode: Column, brand: Column, toks: Column, amount: Column) -> Column:
    joined = F.when(F.size(toks) > 0, F.array_join(toks, "-")).otherwise(F.lit("unknown"))
    built = F.concat(F.lit("tok:"), F.coalesce(brand, F.lit("unknown")), F.lit("|"), joined, F.lit("|"), F.coalesce(amount.cast("string"), F.lit("na")))
    return F.when(barcode.isNotNull(), F.concat(F.lit("ean:"), barcode)).otherwise(built)

