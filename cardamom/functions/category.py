"""Categories from keys, paths and names, by ordered rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions import constants as K
from cardamom.functions.text import holds_any, url_path


def slug(c: Column) -> Column:
    return F.translate(F.lower(c), "_,", "--")


def by_rules(text: Column, rules=K.CATEGORY_RULES) -> Column:
    """The category of the first rule with a word in the text; null if none."""
    out = None
    for words, name in rules:
        hit = holds_any(slug(text), words)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def canonical(category: Column) -> Column:
    return F.when(category.isin(*K.CATEGORIES), category).otherwise(F.lit(K.OTHER))


def from_key(key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in K.CATEGORY_OF_KEY.items() for x in pair])
    return canonical(F.coalesce(F.try_element_at(table, key), by_rules(key)))


def from_url(url: Column) -> Column:
    return canonical(by_rules(F.regexp_replace(url_path(url), "^/+|/+$", "")))


def from_dotted_url(url: Column) -> Column:
    """From the part after /categorie/, whose levels are set apart by points."""
    tail = F.get(F.split(F.element_at(F.split(url, "/categorie/"), -1), r"\?"), F.lit(0))
    return canonical(by_rules(F.replace(tail, F.lit("."), F.lit("-"))))


def from_name(name: Column) -> Column:
    low = F.lower(name)
    care = low.rlike(r"(?U)\bspf\d*") | holds_any(low, K.CARE_WORDS)
    return (
        F.when(care, F.lit("Personal Care"))
        .when(holds_any(low, K.HOUSEHOLD_WORDS), F.lit("Household"))
        .when(holds_any(low, K.TOILETRY_WORDS), F.lit("Personal Care"))
        .otherwise(canonical(by_rules(F.replace(low, F.lit(" "), F.lit("-")))))
    )
