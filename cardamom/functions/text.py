"""String columns: white space, lines, keywords, promotion phrases, titles, URLs."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import constants as K

#: White space as Unicode has it, and the four separators below U+0020.
SPACE = r"[\s\x1C-\x1F]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, and standing once in the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that no later step computes again: what stands above is not pushed below it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space at either end (F.trim knows only U+0020)."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(strip(c), rf"(?U){SPACE}+", " ")


def lines(c: Column) -> Column:
    """The stripped, non-empty lines (cut at line feeds)."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def all_lines(c: Column) -> Column:
    """The same, cut at every line boundary that Unicode knows."""
    return F.filter(F.transform(F.split(c, r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85\u2028\u2029]"), strip), lambda x: x != "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, rf"(?U){SPACE}+"), lambda x: x != "")


def holds_any(c: Column, keys: Iterable[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.contains(c, F.lit(k))
    return out


def starts_any(c: Column, keys: Iterable[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.startswith(c, F.lit(k))
    return out


def quoted(words_: Iterable[str]) -> str:
    """An alternation of literals, the longest first."""
    return "|".join(re.escape(w) for w in sorted(words_, key=len, reverse=True))


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """The first match, or null."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), F.lit(0))


def cut_out(c: Column, literals: Iterable[str]) -> Column:
    for x in literals:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def strip_promo(name: Column) -> Column:
    """A name without promotion phrases: cut at each fragment in turn, then rewritten by each pattern."""
    for x in K.PROMO_FRAGMENTS:
        name = F.regexp_replace(name, rf"(?isU){re.escape(x)}.*", "")
    for pattern, cased in K.PROMO_REMOVALS:
        name = F.regexp_replace(name, ("(?Ud)" if cased else "(?iUd)") + pattern, "")
    return collapse(name)


def capitals(c: Column) -> Column:
    """Words of letters alone with a capital first and small letters after it; other words as they are."""
    one = lambda w: F.when(w.rlike(r"^\p{L}+$"), F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))).otherwise(w)
    return F.array_join(F.transform(words(c), one), " ")


def url_path(url: Column) -> Column:
    """The path of a URL, also of one without scheme; null stays null."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def last_segment(url: Column) -> Column:
    """The last part of the path, slashes at its end aside."""
    return F.element_at(F.split(F.regexp_replace(url_path(url), "/+$", ""), "/"), -1)


def drop_param(url: Column, name: str) -> Column:
    """A URL without one query parameter."""
    out = F.regexp_replace(url, rf"([?&]){re.escape(name)}=[^&#]*&?", "$1")
    return F.regexp_replace(out, r"[?&](?=#|$)", "")


def with_page(url: Column, page: Column, name: str = "pagina") -> Column:
    """A URL whose page parameter is ``page``; the first page has none."""
    bare = drop_param(url, name)
    sep = F.when(F.contains(bare, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when(page > 1, F.concat(bare, sep, F.lit(f"{name}="), page.cast("string"))).otherwise(bare)


def listing_path(url: Column) -> Column:
    return F.regexp_replace(url_path(url), "/+$", "")


def is_generic_listing(url: Column) -> Column:
    """Whether a URL is the index of all products."""
    return listing_path(url).isin("", "/producten")


def listing_cache_key(source_url: Column, target_url: Column) -> Column:
    return F.when(is_generic_listing(target_url), F.concat(source_url, F.lit("|"), target_url)).otherwise(target_url)


def is_category_page(url: Column) -> Column:
    """Whether a URL is a category under /producten/."""
    path = url_path(url)
    return F.startswith(path, F.lit("/producten/")) & (F.regexp_replace(F.substring(path, 12, 1 << 20), "^/+|/+$", "") != "")


def taxonomy_id(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, r"/producten/(\d+)/", 1))


def is_optional_category(name: Column, url: Column, names: Iterable[str] = (), url_parts: Iterable[str] = ()) -> Column:
    """Whether a category may be empty without failing its run: by its name or a part of its URL."""
    return F.coalesce(name.isin(*names) if names else F.lit(False), F.lit(False)) | F.coalesce(holds_any(url, url_parts), F.lit(False))
