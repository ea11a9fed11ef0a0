"""Registered queries of the catalog core: layouts, cleaning, scans, payloads, sinks, runs, streams.

Cards, records and files are built from the tables; the SQL twins state what must come out of them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.functions import barcode as B
from cardamom.functions import constants as K
from cardamom.functions import identity as I
from cardamom.functions import price as P
from cardamom.functions import text as T
from cardamom.operators import dedupe, drift, health, overlap, quality, sanitize, sets
from cardamom.plans import layouts, pipeline
from cardamom.plans.catalog_queries import _table, query
from cardamom.sources import json_catalog, payloads, sinks, stores
from cardamom.streaming import cards as streams

#: Parts of a card, in Spark and in SQL: whole euros, cents, a number, a name.
_PARTS = {"E": "p_partkey % 90 + 1", "C": "p_partkey * 7 % 90 + 10", "N": "p_size", "X": "p_name"}
_SQL = {"E": "(p_partkey % 90 + 1)", "C": "(p_partkey * 7 % 90 + 10)", "N": "p_size", "X": "p_name"}


def _part(k: str) -> Column:
    return F.expr(_PARTS[k]).cast("string")


def _said(form: str) -> Column:
    """A text whose {E}, {C}, {N}, {X} are the row's parts; " / " ends a line."""
    out = F.lit(form.replace(" / ", "\n"))
    for k in _PARTS:
        out = F.replace(out, F.lit("{%s}" % k), _part(k))  # noqa: UP031
    return out


def _said_sql(form: str) -> str:
    for k, c in _SQL.items():
        form = form.replace("{%s}" % k, f"' || {c} || '")  # noqa: UP031
    return f"'{form}'"


def _turn(column: str, choices: list[Column]) -> Column:
    return F.get(F.array(*choices), (F.col(column) % len(choices)).cast("int"))


def _layout(layout: str, *forms: tuple[str, str, str, str, str]) -> None:
    """A query that parses cards of the given forms (text; name, price, offer, size)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        image = F.when(F.col("p_partkey") % 7 == 0, F.lit(K.NO_IMAGE)).otherwise(F.concat(F.lit("i"), F.col("p_partkey").cast("string")))
        cards = _table(spark, sf_dir, "part").select("p_partkey", _turn("p_partkey", [_said(f[0]) for f in forms]).alias("raw_text"), image.alias("image"))
        return layouts.parse_cards(cards, layout).select("p_partkey", *"nposl")

    columns = [f"CASE p_partkey % {len(forms)} " + " ".join(f"WHEN {k} THEN {_said_sql(f[i])}" for k, f in enumerate(forms)) + f" END AS {c}" for i, c in enumerate("npos", 1)]
    missing = "''" if layout in ("albert-heijn", "coop") else f"'{K.NO_IMAGE}'"
    run.__name__ = f"layout_{layout.replace('-', '_')}"
    query(f"SELECT p_partkey, {', '.join(columns)}, CASE WHEN p_partkey % 7 = 0 THEN {missing} ELSE 'i' || p_partkey END AS l FROM part")(run)


_layout(
    "albert-heijn",
    ("{X} / van 99,99 / {E},{C} / {N}0 g", "{X}", "{E}.{C}", "van 99,99", "{N}0 g"),
    ("{X} / 2 voor 99,50", "{X}", "", "2 voor 99,50", ""),
    ("{X} / {E},{C} / 95,75", "{X}", "95.75", "", ""),
    ("{N}0 g / {X} / {E},{C}", "{X}", "{E}.{C}", "", "{N}0 g"),
    (" \t/ {X}", "/ {X}", "", "", ""),
)
_layout(
    "coop",
    ("{X} / {E},{C} / korting 98,00 / {N}0 ml", "{X}", "{E}.{C}", "korting 98,00", "{N}0 ml"),
    ("{N} stuks / {X} / {E},{C}", "{X}", "{E}.{C}", "", "{N} stuks"),
    ("", "", "", "", ""),
)
_layout(
    "jumbo",
    ("{X} 1L 123 / Prijs: € {E},{C}", "{X} 1", "{E}.{C}", "", "1L"),
    ("{X} abcd / actie nu / {E},{C} / 97,20", "{X}", "{E}.{C}", "actie nu", ""),
    ("abcd / {E},{C}", "abc", "{E}.{C}", "", ""),
    ("{X}-{N}0 ml. / 2 voor 96,00 / {E},{C}", "{X}-{N}", "{E}.{C}", "2 voor 96,00", "{N}0 ml"),
)
_layout(
    "aldi",
    ("In de aanbieding / MILSANI / {X} / {N} l / {E}.{C}", "{X}", "{E}.{C}", "In de aanbieding", "{N} l"),
    ("Inhoud: {N} Stuks / {X} / {E}.{C}", "{X}", "{E}.{C}", "", "{N} stuks"),
    ("{X} / short / {X} / a=b", "{X}", "", "", ""),
)
_layout(
    "dirk",
    ("{E} / {C} / {X} / {N} l", "{X}", "{E}.{C}", "", "{N} l"),
    ("{C} / {X} / 2e gratis / {N} l / gratis ijs", "{X} gratis ijs", "{C}", "2e gratis", "{N} l"),
    ("{X} / {N} kg", "{X}", "", "", "{N} kg"),
)
_layout(
    "dirk-promo",
    ("ACTIE / {C} / {X} / {N}0 g", "{X}", "0.{C}", "ACTIE", "{N}0 g"),
    ("{E} / {C} / {X} / vanaf nu / 1+1 gratis", "{X}", "{E}.{C}", "vanaf nu 1+1 gratis", ""),
    ("1 / 2 / 3 / {X}", "{X}", "", "", ""),
)
_layout(
    "lidl",
    ("{X} / -20% / {E}.{C} / {N}0 g", "{X} {N}0", "{E}.{C}", "-20%", "{N}0 G"),
    ("{X} / {E}.{C}", "{X}", "{E}.{C}", "", ""),
    ("{X} {X} / ACTIE / 95.50 / {E}.{C}", "{X}", "{E}.{C}", "ACTIE", ""),
)
_layout(
    "plus",
    ("{X} / Per {N} l / {E},{C}", "{X}", "{E}.{C}", "", "Per {N} l"),
    ("1+1 gratis / {X} / 500 ml / {E},{C}", "{X}", "{E}.{C}", "1+1 gratis", "500 ml"),
    ("{X}! / 350", "{X}!", "3.50", "", ""),
)


def _check_digit(digits: str, odd: int, even: int) -> str:
    """SQL for the check digit of a text of digits; the first has the weight ``odd``."""
    return f"CAST((10 - list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CAST(substr({digits}, i, 1) AS INT) * (CASE WHEN i % 2 = 1 THEN {odd} ELSE {even} END))) % 10) % 10 AS INT)"


def _made_code(digits: Column, n: int, odd: int, even: int) -> Column:
    """The digits and their check digit."""
    total = sum((F.substring(digits, k + 1, 1).cast("int") * (odd if k % 2 == 0 else even) for k in range(n)), F.lit(0))
    return F.concat(digits, F.pmod(10 - total % 10, F.lit(10)).cast("string"))


_TWELVE_SQL = "'87' || lpad(CAST(p_partkey * 7 AS VARCHAR), 10, '0')"
_CODES_SQL = f"c AS (SELECT *, d || {_check_digit('d', 1, 3)} AS ean FROM (SELECT *, {_TWELVE_SQL} AS d FROM part))"


def _eans(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "part").withColumn("ean", _made_code(F.concat(F.lit("87"), F.lpad((F.col("p_partkey") * 7).cast("string"), 10, "0")), 12, 1, 3))


@query(f"""WITH s AS (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 7, '4') AS d FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN d || {_check_digit("d", 3, 1)} END AS barcode FROM s""")
def barcode_ean8(spark, sf_dir):
    digits = F.lpad(F.col("p_partkey").cast("string"), 7, "4")
    good = _made_code(digits, 7, 3, 1)
    wrong = F.concat(digits, F.pmod(F.substring(good, 8, 1).cast("int") + 1, F.lit(10)).cast("string"))
    forms = [good, F.concat(F.lit("EAN "), F.substring(good, 1, 4), F.lit("-"), F.substring(good, 5, 4)), wrong]
    return _table(spark, sf_dir, "part").select("p_partkey", B.normalize_barcode(_turn("p_partkey", forms)).alias("barcode"))


@query(f"""WITH s AS (SELECT p_partkey, '0' || lpad(CAST(p_partkey * 3 AS VARCHAR), 11, '6') AS d FROM part)
SELECT p_partkey, d || {_check_digit("d", 1, 3)} AS barcode FROM s""")
def barcode_padding(spark, sf_dir):
    whole = _made_code(F.concat(F.lit("0"), F.lpad((F.col("p_partkey") * 3).cast("string"), 11, "6")), 12, 1, 3)
    return _table(spark, sf_dir, "part").select("p_partkey", B.normalize_barcode(F.concat_ws(" ", F.substring(whole, 2, 6), F.substring(whole, 8, 6))).alias("barcode"))


@query(f"WITH {_CODES_SQL} SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN ean END AS barcode FROM c")
def barcode_texts(spark, sf_dir):
    forms = [F.concat(F.lit("art. 1234567890123 ean:"), F.col("ean"), F.lit(".")), F.concat(F.lit("x"), F.col("ean")), F.concat(F.col("ean"), F.lit("9"))]
    return _eans(spark, sf_dir).select("p_partkey", B.barcode_in_text(_turn("p_partkey", forms)).alias("barcode"))


def _records(spark, sf_dir) -> DataFrame:
    """Rows with a VARIANT record that labels the code in one of several ways, or not at all."""
    code = lambda form: F.replace(F.lit(form), F.lit("{}"), F.col("ean"))
    forms = ['{"n": "x", "ean": "{}"}', '{"gtin": "123", "barCode": {}}', '{"product": {"gtin13": "{}"}}', '{"attributes": {"b": "{}"}}', '{"barcodes": ["1", {"value": "{}"}]}', '{"sku": "{}"}']
    return _eans(spark, sf_dir).withColumn("_row", F.try_parse_json(_turn("p_partkey", [code(f) for f in forms])))


@query(f"WITH {_CODES_SQL} SELECT p_partkey, CASE WHEN p_partkey % 6 < 5 THEN ean END AS barcode FROM c")
def labelled_barcodes(spark, sf_dir):
    return _records(spark, sf_dir).select("p_partkey", B.labelled_barcode(F.col("_row")).alias("barcode"))


@query(f"WITH {_CODES_SQL} SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'own' WHEN p_partkey % 6 < 5 THEN ean ELSE '' END AS b, p_partkey % 4 <> 0 AND p_partkey % 6 < 5 AS added FROM c")
def backfill_barcodes(spark, sf_dir):
    rows = _records(spark, sf_dir).withColumn("b", F.when(F.col("p_partkey") % 4 == 0, F.lit("own")).otherwise(F.lit("")))
    return sanitize.backfill_barcodes(rows).select("p_partkey", "b", F.col("_added").alias("added"))


@query(f"WITH {_CODES_SQL} SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN ean END AS barcode FROM c")
def card_barcodes(spark, sf_dir):
    null, none = F.lit(None).cast("string"), F.array().cast("array<string>")
    script = F.array(F.lit("[1]"), F.concat(F.lit('{"gtin13": "'), F.col("ean"), F.lit('"}')))
    own = [B.card_barcode(F.col("ean"), null, F.lit("12"), none), B.card_barcode(null, F.col("ean"), null, none), B.card_barcode(F.lit("no"), null, F.col("ean"), none), B.card_barcode(null, null, null, script), B.card_barcode(null, null, null, none)]
    return _eans(spark, sf_dir).select("p_partkey", _turn("p_partkey", own).alias("barcode"))


_WORDS = "string_split(p_name, ' ')"
_BRAND = f"list_filter({_WORDS}, lambda x: x IN ('old', 'red'))[1]"
_TITLE = f"array_to_string(list_transform({_WORDS}, lambda x: upper(x[1]) || x[2:]), ' ')"


def _raw_rows(spark, sf_dir) -> DataFrame:
    names = [F.concat("p_name", F.lit(" vanaf 2,99")), F.lit("x"), F.concat(F.lit("Campina "), "p_name"), F.concat(F.lit("nu voor "), "p_name")]
    sizes = [F.concat(_part("N"), F.lit("0 g")), F.lit("kilo"), F.lit("2 x 50 ml"), F.lit("")]
    return _eans(spark, sf_dir).select("p_partkey", _turn("p_partkey", names).alias("n"), _turn("p_partkey", sizes).alias("s"), F.when(F.col("p_partkey") % 4 == 2, F.col("ean")).otherwise("17").alias("b"))


@query(f"""WITH {_CODES_SQL}, b AS (SELECT *, CASE WHEN p_partkey % 4 = 2 THEN 'campina' ELSE {_BRAND} END AS brand FROM c WHERE p_partkey % 2 = 0),
t AS (SELECT *, list_sort(list_distinct(list_filter({_WORDS}, lambda x: x IS DISTINCT FROM brand))) AS w FROM b)
SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN 'Campina ' ELSE '' END || {_TITLE} AS n, coalesce(brand || ' ', '') || array_to_string(w, ' ') AS cn,
  CASE WHEN p_partkey % 4 = 2 THEN 'ean:' || ean ELSE 'tok:' || coalesce(brand, 'unknown') || '|' || array_to_string(w, '-') || '|' || (p_size * 10) END AS ik,
  brand AS bn, CAST(CASE WHEN p_partkey % 4 = 2 THEN 100 ELSE p_size * 10 END AS BIGINT) AS wg, CASE WHEN p_partkey % 4 = 2 THEN '100 ml' ELSE (p_size * 10) || ' ml' END AS s, CASE WHEN p_partkey % 4 = 2 THEN ean ELSE '17' END AS b FROM t""")
def sanitize_rows(spark, sf_dir):
    return sanitize.sanitize(_raw_rows(spark, sf_dir)).select("p_partkey", "n", "cn", "ik", "bn", "wg", "s", "b")


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'x' ELSE 'nu voor ' || p_name END AS n, CASE p_partkey % 4 WHEN 1 THEN 'kilo' ELSE '' END AS s, CAST(NULL AS VARCHAR) AS ik FROM part WHERE p_partkey % 2 = 1")
def sanitize_rejects(spark, sf_dir):
    return sanitize.rejected(_raw_rows(spark, sf_dir)).select("p_partkey", "n", "s", "ik")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Dairy & Eggs' WHEN 1 THEN 'Bakery' ELSE 'Other' END AS c, p_partkey % 3 = 0 AS kept, CASE p_partkey % 3 WHEN 2 THEN NULL ELSE 'k' END AS l FROM part""")
def enrich_rows(spark, sf_dir):
    """Categories given or told from the text; rows that are no products stay as they are."""
    raw = [F.lit("Kaas jong"), F.lit("x"), F.lit("zz")]
    rows = _table(spark, sf_dir, "part").select("p_partkey", _turn("p_partkey", raw).alias("raw_text"), _turn("p_partkey", raw).alias("n"), F.when(F.col("p_partkey") % 3 == 1, F.lit("Bakery")).otherwise(F.when(F.col("p_partkey") % 3 == 2, F.lit("nothing"))).alias("category"), F.when(F.col("p_partkey") % 3 < 2, F.lit("k")).alias("l"))
    return sanitize.enrich(rows).select("p_partkey", "c", F.col("ik").isNotNull().alias("kept"), "l")


@query("""WITH r AS (SELECT p_partkey, p_partkey % 2 AS store, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_name || p_brand END, CASE WHEN p_partkey % 3 = 1 THEN p_name END, p_type) AS k,
  CASE WHEN p_partkey % 5 = 4 THEN CAST('inf' AS DOUBLE) ELSE CAST((p_partkey % 90 + 1) || '.' || (p_partkey * 7 % 90 + 10) AS DOUBLE) END AS price FROM part)
SELECT p_partkey, first_ord FROM (SELECT p_partkey, row_number() OVER (PARTITION BY store, k ORDER BY price, p_partkey) AS rn, min(p_partkey) OVER (PARTITION BY store, k) AS first_ord FROM r) WHERE rn = 1""")
def keep_cheapest_fallback(spark, sf_dir):
    k = F.col("p_partkey") % 3
    rows = _table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_partkey") % 2).alias("store"), F.when(k == 0, F.concat("p_name", "p_brand")).otherwise("").alias("ik"), F.when(k == 1, F.col("p_name")).alias("cn"), F.col("p_type").alias("n"),
        F.when(F.col("p_partkey") % 5 == 4, F.lit("gratis")).otherwise(F.concat(F.lit("€ "), _part("E"), F.lit(","), _part("C"), F.lit(" nu"))).alias("p"),
    )
    return dedupe.keep_cheapest(rows, ord_col="p_partkey", within=("store",)).select("p_partkey", F.col("_first_ord").alias("first_ord"))


@query("""SELECT min(event_id) AS event_id FROM events GROUP BY CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'w' || (user_id % 10) WHEN 2 THEN CAST(user_id AS VARCHAR) ELSE '{"x":' || (user_id % 5) || '}' END""")
def keep_first_ids(spark, sf_dir):
    u = F.col("user_id")
    text = lambda a, v, b="}": F.concat(F.lit(a), v.cast("string"), F.lit(b))
    forms = [text('{"id": ', u), text('{"id": "", "webshopId": "w', u % 10, '"}'), text('{"webshopId": 1, "id": "', u, '"}'), text('{"x": ', u % 5)]
    rows = _table(spark, sf_dir, "events").select(F.col("event_id").alias("_ord"), F.parse_json(_turn("event_id", forms)).alias("_row"))
    return dedupe.keep_first_id(rows).select(F.col("_ord").alias("event_id"))


def _files(spark, sf_dir) -> DataFrame:
    """Catalog files by their text: arrays with elements that are no products, an object, no JSON, a text."""
    forms = ['[{"n": "{}", "p": "1.50", "q": 1}, 7, "x", {"n": null, "p": 2}, null, [1]]', '{"n": "{}", "raw_text": "one"}', "{not json", '"{}"', "[]"]
    texts = [F.replace(F.lit(f), F.lit("{}"), F.col("n_name")) for f in forms]
    files = _table(spark, sf_dir, "nation").select(F.concat(F.lit("f/"), "n_name").alias("path"), F.lit(5).cast("long").alias("changed_at"), _turn("n_nationkey", texts).alias("value"))
    return json_catalog.shaped(files)


@query("""SELECT 'f/' || n_name AS path, CAST(o AS BIGINT) AS ord, o IN (0, 3) AS is_object, CASE o WHEN 0 THEN n_name END AS n, CASE o WHEN 0 THEN '1.50' WHEN 3 THEN '2' END AS p FROM nation, range(6) AS r(o) WHERE n_nationkey % 5 = 0""")
def catalog_elements(spark, sf_dir):
    rows = json_catalog.typed(json_catalog.elements(_files(spark, sf_dir)), sanitize.PRODUCT)
    return rows.select("path", F.col("_ord").alias("ord"), F.col("_is_object").alias("is_object"), "n", "p")


@query("""SELECT 'f/' || n_name AS path, CAST(CASE n_nationkey % 5 WHEN 0 THEN 6 ELSE 0 END AS BIGINT) AS count, CASE n_nationkey % 5 WHEN 2 THEN 'catalog is unreadable' WHEN 1 THEN 'catalog root is not a JSON array' WHEN 3 THEN 'catalog root is not a JSON array' END AS read_error, CAST(5 AS BIGINT) AS changed_at FROM nation""")
def catalog_reasons(spark, sf_dir):
    return json_catalog.read_reasons(_files(spark, sf_dir))


@query("""SELECT 'f/' || n_name AS path, CAST(o AS BIGINT) AS ord, CASE WHEN n_nationkey % 5 = 1 THEN 'one' END AS raw_text FROM nation, range(4) AS r(o) WHERE (n_nationkey % 5 = 0 AND o IN (0, 3)) OR (n_nationkey % 5 = 1 AND o = 0)""")
def card_fragments(spark, sf_dir):
    return json_catalog.cards(_files(spark, sf_dir)).select("path", F.col("_ord").alias("ord"), "raw_text")


@query("SELECT count(*) AS files, count(*) FILTER (n_nationkey % 5 IN (0, 1, 4)) AS readable FROM nation")
def fragment_counts(spark, sf_dir):
    return json_catalog.fragment_counts(_files(spark, sf_dir))


@query("SELECT CASE n_regionkey WHEN 0 THEN 'nl' ELSE 'r' || n_regionkey END AS country, n_name AS store, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END AS BIGINT) AS total FROM nation WHERE n_nationkey % 7 <> 0")
def baseline_snapshot(spark, sf_dir):
    country = F.when(F.col("n_regionkey") == 0, F.lit("")).otherwise(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
    one = F.struct(country.alias("country"), F.when(F.col("n_nationkey") % 7 != 0, F.col("n_name")).alias("store"), F.when(F.col("n_nationkey") % 3 != 0, F.col("n_nationkey")).alias("total"))
    files = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("path"), F.lit(0).cast("long").alias("changed_at"), F.concat(F.lit("["), F.to_json(one), F.lit("]")).alias("value"))
    return json_catalog.baseline(json_catalog.shaped(files))


def _stores(spark, sf_dir) -> DataFrame:
    """The store dimension of a configuration in which regions are countries and nations are stores."""
    store = F.struct(F.col("n_name").alias("display_name"), F.concat(F.lit("d/"), "n_name").alias("dir"), F.lit("c.json").alias("catalog"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey").cast("int")).alias("minimum_products"), F.array(F.concat(F.lit("*."), "n_name"), F.lit("t")).alias("intermediate_globs"))
    country = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    per = _table(spark, sf_dir, "nation").groupBy(country.alias("k")).agg(F.map_from_entries(F.collect_list(F.struct("n_name", store))).alias("stores"))
    doc = per.agg(F.to_json(F.struct(F.lit("r1").alias("default_country"), F.map_from_entries(F.collect_list(F.struct("k", F.struct(F.upper("k").alias("label"), F.lit("EUR").alias("currency"), "stores")))).alias("countries"))).alias("value"))
    return stores.store_rows(doc)


@query("SELECT 'r' || n_regionkey AS country, 'R' || n_regionkey AS label, 'EUR' AS currency, n_name AS store, 'd/' || n_name || '/c.json' AS catalog_path, CAST(CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey END AS INT) AS minimum_products, n_regionkey = 1 AS is_default FROM nation")
def store_dimension(spark, sf_dir):
    return _stores(spark, sf_dir).select("country", "label", "currency", "store", "catalog_path", "minimum_products", "is_default")


@query("SELECT 'all' AS choice, n_name AS store FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'one', n_name FROM nation WHERE n_regionkey = 2 AND n_name = (SELECT min(n_name) FROM nation WHERE n_regionkey = 2)")
def store_selection(spark, sf_dir):
    dim = _stores(spark, sf_dir)
    first = _table(spark, sf_dir, "nation").filter("n_regionkey = 2").agg(F.min("n_name").alias("n")).first()["n"]
    return stores.select(dim).select(F.lit("all").alias("choice"), "store").unionByName(stores.select(dim, "r2", first).select(F.lit("one").alias("choice"), "store"))


@query("SELECT 'r' || n_regionkey AS country, n_name AS store, unnest(['*.' || n_name, 't']) AS glob FROM nation")
def intermediate_globs(spark, sf_dir):
    return stores.intermediate_globs(_stores(spark, sf_dir))


@query("SELECT * FROM (VALUES ('a', 'https://a/1', 0), ('a', 'https://a/2', 1), ('b', 'https://b/1', 0)) AS v(store, url, ord)")
def seed_urls(spark, sf_dir):
    return stores.seed_urls(spark, {"a": ["https://a/1", "https://a/2"], "b": ["https://b/1"]}).select("store", "url", F.col("_ord").alias("ord"))


#: A code with a right check digit.
_VALID = "8710398500014"


def _payload(spark, sf_dir, *forms: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", F.parse_json(_turn("p_partkey", [_said(f) for f in forms])).alias("_row"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Brand ' || p_name || chr(10) || 'van 12,50' || chr(10) || {E} || ',' || {C} || chr(10) || p_size || '0 g' WHEN 1 THEN p_name || chr(10) || {E} || ',' || {C} ELSE p_name || chr(10) || '1+1 gratis' || chr(10) || '2,00' END AS raw_text,
  CASE p_partkey % 3 WHEN 0 THEN 'u' || p_size WHEN 1 THEN 'h' ELSE 's' END AS image, CASE p_partkey % 3 WHEN 2 THEN '8710398500014' END AS barcode FROM part""".format(**_SQL).replace("8710400000013", "8710398500014"))
def ah_cards(spark, sf_dir):
    forms = (
        '{"brand": "Brand ", "title": "{X}", "isBonus": true, "bonusMechanism": "", "priceBeforeBonus": 12.5, "currentPrice": {E}.{C}, "salesUnitSize": "{N}0 g", "images": [{"url": "u{N}"}]}',
        '{"title": " {X}", "isBonus": false, "bonusMechanism": "x", "priceBeforeBonus": {E}.{C}, "images": [{"url": "", "href": "h"}]}',
        '{"title": "{X}", "isBonus": true, "bonusMechanism": "1+1 gratis", "currentPrice": 2, "images": ["s"], "gtin": "' + _VALID + '"}',
    )
    rows = _payload(spark, sf_dir, *forms).withColumn("card", payloads.ah_card(F.col("_row")))
    return rows.select("p_partkey", "card.raw_text", "card.image", "card.barcode")


@query("SELECT p_partkey, 'a,b' AS ids, CAST(CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS VARCHAR) AS taxonomy FROM part")
def ah_taxonomy(spark, sf_dir):
    rows = _payload(spark, sf_dir, '{"filters": [{"id": "price", "options": [{"id": "z"}]}, {"id": "taxonomy", "options": [{"id": "a"}, {"id": ""}, {"x": 1}, {"id": "b"}]}, {"id": "taxonomy", "options": [{"id": "c"}]}]}')
    url = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), _turn("p_partkey", [_said("https://x.nl/producten/{N}/kaas"), _said("https://x.nl/producten/kaas/{N}")]).alias("url"))
    return rows.join(url, F.col("p_partkey") == F.col("k")).select("p_partkey", F.array_join(payloads.ah_child_ids(F.col("_row")), ",").alias("ids"), T.taxonomy_id(F.col("url")).alias("taxonomy"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || chr(10) || '2 voor 3' || chr(10) || 'Prijs: € ' || {E} || ',' || {C} WHEN 1 THEN p_name || chr(10) || 'Prijs: € 0,00' ELSE p_name END AS raw_text, CASE p_partkey % 3 WHEN 0 THEN 'i' END AS image, CASE p_partkey % 3 WHEN 0 THEN '/p' END AS link FROM part""".format(**_SQL))
def jumbo_cards(spark, sf_dir):
    forms = ('{"title": "{X}", "promotions": [{"tags": [{"text": "2 voor 3"}, {"text": "no"}]}], "prices": {"price": {E}{C}}, "image": "i", "link": "/p"}', '{"title": "{X} ", "promotions": [{"tags": [{"text": 5}]}], "prices": {"promoPrice": 0, "price": 250}}', '{"title": "{X}", "promotions": []}')
    return _payload(spark, sf_dir, *forms).withColumn("card", payloads.jumbo_card(F.col("_row"))).select("p_partkey", "card.raw_text", "card.image", "card.link")


@query("""WITH r AS (SELECT p_partkey, 'Merk ' || p_name || chr(10) || p_size || ' st' || chr(10) || {E} || ',' || {C} AS raw_text, 'https://p/producten/s' || p_size AS link FROM part UNION ALL SELECT p_partkey, p_name || chr(10) || '3,00', NULL FROM part)
SELECT p_partkey, raw_text, link, coalesce(link, raw_text) AS identity FROM r""".format(**_SQL))
def plus_cards(spark, sf_dir):
    form = '{"ProductList": {"List": [{"PLP_Str": {"Brand": "Merk", "Name": "{X}", "Product_Subtitle": "{N} st", "NewPrice": "{E}.{C}", "OriginalPrice": "9", "Slug": "s{N}"}}, 5, {"Name": "{X}", "NewPrice": "0", "OriginalPrice": "3"}, {"Name": ""}]}}'
    rows = payloads.plus_products(_payload(spark, sf_dir, form), "_row", "https://p")
    return rows.select("p_partkey", "raw_text", "link", payloads.card_identity(F.col("link"), F.col("raw_text")).alias("identity"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '' ELSE 'Prijs: € ' || replace(printf('%.2f', event_id / 100.0), '.', ',') END AS cents, CASE event_id % 4 WHEN 0 THEN event_id || ',00' WHEN 1 THEN event_id || ',5' ELSE '' END AS comma FROM events WHERE event_id > 0""")
def price_formats(spark, sf_dir):
    e = F.col("event_id")
    forms = [e.cast("string"), F.concat(e.cast("string"), F.lit(".5")), F.lit("0.0"), F.lit("")]
    return _table(spark, sf_dir, "events").filter("event_id > 0").select("event_id", P.cents_line(F.when(e % 4 != 3, e)).alias("cents"), P.comma_price(_turn("event_id", forms)).alias("comma"))


@query("SELECT p_partkey, CAST(round_even(p_size + 0.5, 0) AS BIGINT) AS halves, CAST(p_size * 1000 + 125 AS BIGINT) AS kilos FROM part")
def size_rounding(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", I.parse_size(F.concat(_part("N"), F.lit(",5 ml"))).alias("halves"), I.parse_size(F.concat(_part("N"), F.lit(".125 kg"))).alias("kilos"))


@query(f"SELECT p_partkey, {_TITLE} || ' 2go ÉCLAIR' AS title, p_name || ' pak' AS bare FROM part".replace("ÉCLAIR", "Éclair"))
def titles(spark, sf_dir):
    tails = [" 50 % korting", " 2e halve prijs", " 1+1 gratis", " -25%", " voor", " goedkoper dan ooit"]
    name = F.concat("p_name", F.lit(" pak"), _turn("p_partkey", [F.lit(t) for t in tails]))
    return _table(spark, sf_dir, "part").select("p_partkey", T.capitals(F.concat("p_name", F.lit("  2go ÉCLAIR "))).alias("title"), T.strip_promo(name).alias("bare"))


@query("""SELECT p_partkey, 'https://x.nl/producten/' || p_size || '?a=1' || CASE WHEN p_partkey % 3 > 0 THEN '&pagina=' || (p_partkey % 3 + 1) ELSE '' END AS page, CASE p_partkey % 3 WHEN 0 THEN 's|https://x.nl/producten/' ELSE 'https://x.nl/producten/' || p_size END AS cache_key, p_partkey % 3 > 0 AS category, p_partkey % 3 = 0 OR p_size % 10 = 7 AS optional FROM part""")
def url_pages(spark, sf_dir):
    page = T.with_page(_said("https://x.nl/producten/{N}?pagina=9&a=1"), F.col("p_partkey") % 3 + 1)
    url = F.when(F.col("p_partkey") % 3 == 0, F.lit("https://x.nl/producten/")).otherwise(_said("https://x.nl/producten/{N}"))
    name = F.when(F.col("p_partkey") % 3 == 0, F.lit("Bloemen")).otherwise(F.lit("Kaas"))
    parts = [f"/producten/{x}7" for x in ("", 1, 2, 3, 4)]
    end = F.concat(url, F.lit("$"))
    return _table(spark, sf_dir, "part").select("p_partkey", page.alias("page"), T.listing_cache_key(F.lit("s"), url).alias("cache_key"), T.is_category_page(url).alias("category"), T.is_optional_category(name, end, ("Bloemen",), [f"{x}$" for x in parts]).alias("optional"))


@query("SELECT n_name AS store, CASE WHEN n_nationkey % 2 = 0 THEN (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) ELSE 0 END AS count, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END AS BIGINT) AS baseline FROM nation")
def store_counts(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation").select(F.lit("nl").alias("country"), F.col("n_name").alias("store"), "n_nationkey")
    counts = _table(spark, sf_dir, "customer").join(nation.filter("n_nationkey % 2 = 0"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("country", "store").agg(F.count("*").alias("count"))
    old = nation.filter("n_nationkey % 3 > 0").select("store", F.col("n_nationkey").alias("total"))
    return drift.against_baseline(nation, counts, old, baseline_by=["store"]).select("store", "count", "baseline")


@query("SELECT 0 AS \"right\", 0 AS before, 0 AS after, 0 AS removed UNION ALL SELECT count(*), (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_size > 25), (SELECT count(*) FROM part WHERE p_size <= 25) FROM part WHERE p_size <= 25")
def overlap_counts(spark, sf_dir):
    part = _table(spark, sf_dir, "part").select(F.lit("").alias("ik"), F.col("p_size").cast("string").alias("b"), F.lit(None).cast("string").alias("cn"))
    found = [overlap.overlap_stats(part, None), overlap.overlap_stats(part, part.filter("cast(b as int) <= 25"))]
    return spark.createDataFrame([tuple(x[k] for k in ("right", "before", "after", "removed")) for x in found], "right int, before int, after int, removed int")


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) - 7200000000 WHEN 2 THEN epoch_us(ts) END AS at FROM events")
def scrape_times(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    first, other = _turn("event_id", [F.concat(iso, F.lit("Z")), F.concat(iso, F.lit("+02:00")), F.lit(""), F.lit("soon")]), iso
    return _table(spark, sf_dir, "events").select("event_id", F.unix_micros(health.scrape_time(first, other)).alias("at"))


@query("SELECT n_name AS store, CASE n_nationkey % 3 WHEN 1 THEN 'catalog_missing' ELSE 'not_a_list' END AS code, 'error' AS status FROM nation WHERE n_nationkey % 3 > 0")
def structural_issues(spark, sf_dir):
    dim = _table(spark, sf_dir, "nation").select(F.lit("nl").alias("country"), F.col("n_name").alias("store"), "n_nationkey")
    why = dim.select("country", "store", F.when(F.col("n_nationkey") % 3 == 1, F.lit("catalog_missing")).when(F.col("n_nationkey") % 3 == 2, F.lit("not_a_list")).alias("reason"))
    return health.structural_issues(dim, why).select("store", F.col("issues")[0]["code"].alias("code"), "status")


@query("SELECT s AS status, f AS fail_on, CAST((s = 'error' AND f <> 'never') OR (s = 'warning' AND f = 'warning') AS INT) AS code FROM (VALUES ('pass'), ('warning'), ('error')) AS a(s), (VALUES ('error'), ('warning'), ('never')) AS b(f)")
def exit_codes(spark, sf_dir):
    rows = [(s, f, health.exit_code(s, f)) for s in ("pass", "warning", "error") for f in ("error", "warning", "never")]
    return spark.createDataFrame(rows, "status string, fail_on string, code int")


def _small_catalog(spark, sf_dir) -> DataFrame:
    """Rows of a store for each region; some names are promotions."""
    n = F.when(F.col("p_partkey") % 10 == 0, F.lit("nu voor 1.00")).otherwise(F.col("p_name"))
    store = F.when(F.col("p_partkey") % 4 == 0, F.lit("lidl")).otherwise(F.concat(F.lit("s"), (F.col("p_partkey") % 4).cast("string")))
    return _table(spark, sf_dir, "part").select(F.lit("nl").alias("country"), store.alias("store"), n.alias("n"), F.lit("1.00").alias("p"), F.lit("").alias("b"), F.col("p_name").alias("ik"), F.col("p_brand").alias("bn"), F.col("p_size").cast("long").alias("wg"), F.lit("u").alias("l"), F.lit(None).cast("string").alias("i"))


_SMALL_SQL = "WITH r AS (SELECT CASE p_partkey % 4 WHEN 0 THEN 'lidl' ELSE 's' || (p_partkey % 4) END AS store, p_partkey % 10 = 0 AS promo, p_name FROM part)"


@query(f"{_SMALL_SQL} SELECT store, count(*) FILTER (promo) AS promo_in_name FROM r WHERE store = 'lidl' GROUP BY 1 HAVING count(*) FILTER (promo) > 0")
def promo_gate(spark, sf_dir):
    return quality.promo_gate(quality.quality(_small_catalog(spark, sf_dir))).select("store", "promo_in_name")


@query(f"""{_SMALL_SQL}, q AS (SELECT store, count(*) AS n, count(*) FILTER (promo) AS promo, count(*) - count(DISTINCT p_name) AS dup FROM r GROUP BY 1)
SELECT '| Country | Store | Total | Barcode | Identity | Brand | Weight | Promo | Dup ik |' AS line UNION ALL SELECT '|---------|-------|------:|--------:|---------:|------:|-------:|------:|-------:|'
UNION ALL SELECT '| nl | ' || store || ' | ' || n || ' | 0 (0%) | ' || n || ' | ' || n || ' | ' || n || ' | ' || promo || ' | ' || dup || ' |' FROM q""")
def quality_markdown(spark, sf_dir):
    text = quality.markdown(quality.quality(_small_catalog(spark, sf_dir)))
    return spark.createDataFrame([(x,) for x in text.split("\n")], "line string")


@query("""SELECT n_name AS store, '::error file=c.json::nl/' || n_name || ': ' || CASE WHEN n_nationkey % 2 = 0 THEN 'catalog file is missing' ELSE 'catalog contains zero products' END || '. Check the store scraper logs and rerun this workflow.' AS annotation FROM nation
UNION ALL SELECT n_name, '::error file=c.json::nl/' || n_name || ': catalog has not changed for ' || CASE WHEN n_nationkey % 2 = 0 THEN 'inf' ELSE '100.0' END || 'h (limit 72h). Check the store scraper logs and rerun this workflow.' FROM nation""")
def ci_annotations(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").select(F.lit("nl").alias("country"), F.col("n_name").alias("store"), F.lit("c.json").alias("catalog"), F.lit(0).cast("long").alias("count"), F.lit(0).cast("long").alias("baseline"), F.lit(0).alias("minimum_products"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("catalog file\nis missing")).alias("read_error"), F.when(F.col("n_nationkey") % 2 == 1, F.lit(1000)).alias("changed_at"))
    return drift.annotations(drift.alerts(rows, F.lit(1000 + 360_000))).select("store", "annotation")


@query("SELECT 'nl' AS country, store, count(*) AS input, count(*) FILTER (NOT promo) AS kept FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'lidl' ELSE 's' || (p_partkey % 4) END AS store, p_partkey % 10 = 0 AS promo FROM part) GROUP BY store UNION ALL SELECT c, NULL, n, k FROM (SELECT unnest(['nl', NULL]) AS c, (SELECT count(*) FROM part) AS n, (SELECT count(*) FROM part WHERE p_partkey % 10 <> 0) AS k)")
def run_totals(spark, sf_dir):
    rows = _small_catalog(spark, sf_dir)
    return pipeline.totals(rows, sanitize.sanitize(rows))


@query("SELECT * FROM (SELECT 'Kaas ' || p_name AS x, min(p_partkey) AS p_partkey FROM part GROUP BY p_name) ORDER BY 1")
def store_run(spark, sf_dir):
    """Cards of one store to its catalog: parsed, cleaned, the first of each name."""
    cards = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_ord"), F.concat_ws("\n", F.concat(F.lit("Kaas "), "p_name"), F.lit("1,50")).alias("raw_text"), F.lit("").alias("image"))
    return pipeline.store_catalog(cards, "coop").select(F.lower("n").alias("low"), "_ord").select(F.concat(F.lit("K"), F.substring("low", 2, 99)).alias("x"), F.col("_ord").alias("p_partkey"))


@query("""WITH d AS (SELECT CASE p_partkey % 2 WHEN 0 THEN p_name || ' ACTIE' ELSE p_name END AS n, p_partkey % 2 AS k, min(p_partkey) AS o FROM part GROUP BY 1, 2)
SELECT o AS p_partkey, k = 0 AS promo, CASE k WHEN 0 THEN '0.99' ELSE '1.25' END AS p FROM d WHERE k = 1 OR split_part(n, ' ACTIE', 1) NOT IN (SELECT n FROM d WHERE k = 1)""")
def dirk_run(spark, sf_dir):
    """Regular and promotional cards of one store, parsed apart; regular rows come first."""
    text = [F.concat_ws("\n", F.lit("ACTIE"), F.lit("99"), F.col("p_name")), F.concat_ws("\n", F.lit("1"), F.lit("25"), F.col("p_name"))]
    cards = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_ord"), _turn("p_partkey", text).alias("raw_text"), F.lit("").alias("image"))
    return pipeline.store_catalog(cards, "dirk").select(F.col("_ord").alias("p_partkey"), (F.col("_branch") == 1).alias("promo"), "p")


def _two_stores(spark, sf_dir) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    store = F.when(F.col("p_partkey") % 2 == 0, F.lit("coop")).otherwise(F.lit("plus"))
    size = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).otherwise(F.least("p_size", F.lit(25))).cast("string"), F.lit("0 g"))
    return part.select(F.lit("nl").alias("country"), store.alias("store"), F.concat(F.lit("Hero "), F.col("p_type"), F.lit(" "), F.regexp_replace(F.lower("p_brand"), "brand#", "m")).alias("n"), P.two_decimals(F.col("p_retailprice")).alias("p"), size.alias("s"), F.col("p_partkey").alias("_ord"))


@query("""WITH r AS (SELECT p_partkey, p_partkey % 2 = 0 AS coop, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE least(p_size, 25) END AS size, lower(p_type) || '|' || p_brand AS t, CAST(printf('%.2f', p_retailprice) AS DOUBLE) AS price FROM part),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coop, t, size ORDER BY price, p_partkey) AS rn FROM r) WHERE rn = 1)
SELECT p_partkey AS ord, CASE WHEN coop THEN 'coop' ELSE 'plus' END AS store FROM k AS a WHERE NOT coop OR NOT EXISTS (SELECT 1 FROM k AS b WHERE NOT b.coop AND b.t = a.t)""")
def sanitize_everything(spark, sf_dir):
    return pipeline.sanitize_all(_two_stores(spark, sf_dir)).select(F.col("_ord").alias("ord"), "store")


@query("""WITH r AS (SELECT p_partkey % 2 = 0 AS coop, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE least(p_size, 25) END AS size, lower(p_type) || '|' || p_brand AS t FROM part),
k AS (SELECT DISTINCT coop, t, size FROM r), c AS (SELECT s AS store, (SELECT count(*) FROM k AS a WHERE a.coop = (s = 'coop') AND (NOT coop OR NOT EXISTS (SELECT 1 FROM k AS b WHERE NOT b.coop AND b.t = a.t))) AS count FROM (VALUES ('coop'), ('plus')) AS v(s))
SELECT store, count, CAST(1000000 AS BIGINT) AS baseline, CASE WHEN store = 'coop' THEN 'NL/coop: ' || count || ' products < minimum 2000000' ELSE 'NL/plus: dropped ' || CAST(round_even(100.0 * (1000000 - count) / 1000000, 0) AS BIGINT) || '% vs baseline 1000000 (now ' || count || ')' END AS failure FROM c""")
def postprocess_gate(spark, sf_dir):
    dim = spark.createDataFrame([("nl", "coop", 2_000_000), ("nl", "plus", 0)], "country string, store string, minimum_products int")
    base = spark.createDataFrame([("nl", "coop", 1_000_000), ("nl", "plus", 1_000_000)], "country string, store string, total long")
    rows = _two_stores(spark, sf_dir).withColumns({"scrapedAt": F.lit("2024-01-01T00:00:00Z"), "scraped_at": F.lit("")})
    return pipeline.postprocess(rows, dim, base, F.lit("2024-01-02 00:00:00").cast("timestamp"))["gate"].select("store", "count", "baseline", "failure")


def _folder(spark: SparkSession) -> str:
    """A new folder for a query that writes, in the shared one if the cluster names one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{(shared or tempfile.mkdtemp(prefix='cardamom-')).rstrip('/')}/catalog-{uuid.uuid4().hex}"


@query("SELECT n_name AS n, CAST(n_nationkey AS BIGINT) AS ord, CASE WHEN n_nationkey % 2 = 0 THEN '1.00' END AS p FROM nation")
def sink_json_array(spark, sf_dir):
    """Rows written as one array, twice over, and read again."""
    rows = _table(spark, sf_dir, "nation").select(F.col("n_name").alias("n"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("1.00")).alias("p"), "n_nationkey")
    path = f"{_folder(spark)}/c.json"
    for _ in range(2):
        sinks.json_array(rows, path, "n_nationkey")
    return json_catalog.read_catalog(spark, path).select("n", F.col("_ord").alias("ord"), "p")


@query("SELECT n_name, n_nationkey + 2 AS n_nationkey FROM nation")
def sink_overwrite(spark, sf_dir):
    """A table that is read and overwritten in one step."""
    path = f"{_folder(spark)}/t"
    sinks.overwrite(_table(spark, sf_dir, "nation").select("n_name", "n_nationkey"), path)
    for _ in range(2):
        sinks.overwrite(spark.read.parquet(path).withColumn("n_nationkey", F.col("n_nationkey") + 1), path)
    return spark.read.parquet(path)


@query("SELECT p_partkey, p_partkey % 2 = 0 AS ok FROM part")
def sink_rejects(spark, sf_dir):
    folder = _folder(spark)
    sinks.with_rejects(sanitize.classify(_raw_rows(spark, sf_dir)), f"{folder}/kept", f"{folder}/rejected")
    read = lambda name, ok: spark.read.schema("p_partkey long").json(f"{folder}/{name}").withColumn("ok", F.lit(ok))
    return read("kept", True).unionByName(read("rejected", False))


@query("SELECT DISTINCT user_id FROM events")
def stream_unseen(spark, sf_dir):
    """The events table as a stream: each user once."""
    source = spark.readStream.schema(_table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = _folder(spark)
    seen = streams.unseen(source.withColumn("at", F.col("ts").cast("timestamp")), ["user_id"], "at", "400 days")
    streams.persist(seen.select("user_id"), lambda df, k: df.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"), f"{folder}/state").awaitTermination()
    return spark.read.schema("user_id long").parquet(f"{folder}/out").select("user_id")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def stream_windows(spark, sf_dir):
    """Hourly counts of the events table as a stream; windows that may still change are not out yet."""
    source = spark.readStream.schema(_table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    folder = _folder(spark)
    counts = streams.windowed_counts(source.withColumn("at", F.col("ts").cast("timestamp")), ["event_type"], "at")
    flat = counts.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")
    streams.persist(flat, lambda df, k: df.write.mode("overwrite").parquet(f"{folder}/out/batch={k}"), f"{folder}/state").awaitTermination()
    return spark.read.schema("start timestamp_ntz, event_type string, n long").parquet(f"{folder}/out").select("start", "event_type", "n")
