import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardamom.operators import dedupe, drift, health, overlap, quality, sanitize, sets

EAN = "4006381333931"


def test_keep_cheapest(spark):
    rows = [(0, "a", "2,50"), (1, "b", "1.00"), (2, "a", "0"), (3, "a", ""), (4, None, "1"), (5, "", "1")]
    df = spark.createDataFrame(rows, "_ord long, ik string, p string").withColumns({"cn": F.lit(None).cast("string"), "n": F.lit("")})
    got = dedupe.keep_cheapest(df).orderBy("_first_ord").select("ik", "p").collect()
    assert [tuple(r) for r in got] == [("a", "0"), ("b", "1.00")]
    assert dedupe.removed_count(df, ["ik", "cn", "n"]).first()["removed"] == 2


def test_keep_cheapest_ties_and_order(spark):
    rows = [(k, "a", "1") for k in range(20)]
    df = spark.createDataFrame(rows, "_ord long, ik string, p string").withColumns({"cn": F.lit(""), "n": F.lit("")}).repartition(5)
    assert dedupe.keep_cheapest(df).first()["_ord"] == 0


def test_keep_first_name(spark):
    df = spark.createDataFrame([(0, "Melk"), (1, " Melk "), (2, ""), (3, "Kaas"), (4, None)], "_ord long, n string")
    assert [r["n"] for r in dedupe.keep_first_name(df).orderBy("_ord").collect()] == ["Melk", "Kaas"]
    assert dedupe.keep_first_name(df, enabled=False).count() == 5


def test_keep_first_id(spark):
    rows = [(0, '{"id": 1, "a": 1}'), (1, '{"id": 1, "a": 2}'), (2, '{"webshopId": "x"}'), (3, '{"webshopId": "x", "b": 1}'), (4, '{"c": 1}'), (5, '{"c": 1}')]
    df = spark.createDataFrame(rows, "_ord long, j string").withColumn("_row", F.parse_json("j"))
    assert sorted(r["_ord"] for r in dedupe.keep_first_id(df.drop("j")).select("_ord").collect()) == [0, 2, 4]


def test_overlap(spark):
    cols = "n string, p string, ik string, b string, cn string"
    plus = spark.createDataFrame([("Halfvolle melk", "1.29", "tok:melk|halfvolle|1000", None, "halfvolle melk"), ("Kaas", "2.50", "tok:kaas|jong|200", "", "kaas jong")], cols)
    coop = spark.createDataFrame([("Halfvolle melk", "1.35", "tok:melk|halfvolle|1000", None, "x"), ("Kaas", "2.60", "other", "", "kaas jong"), ("Coop-only brood", "1.10", "tok:brood|coop-only|400", "", None)], cols)
    assert [r["n"] for r in overlap.without_overlap(coop, plus).collect()] == ["Coop-only brood"]
    assert sorted(r["n"] for r in overlap.overlap(coop, plus, "n").collect()) == ["Halfvolle melk", "Kaas"]
    assert overlap.overlap_stats(coop, plus) == {"right": 2, "before": 3, "after": 1, "removed": 2}
    assert overlap.overlap_stats(coop, None)["removed"] == 0
    plan = overlap.without_overlap(coop, plus)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan


SANITIZED = [
    ({"n": "Campina halfvolle melk 1 l", "s": "1 l"}, {"n": "Campina Halfvolle Melk 1 L", "bn": "campina", "wg": 1000, "s": "1 l", "cn": "campina halfvolle melk", "ik": "tok:campina|halfvolle-melk|1000"}),
    ({"n": "Douwe Egberts koffie 500 g", "s": "500 g"}, {"bn": "douwe egberts", "s": "500 ml", "cn": "douwe egberts koffie", "ik": "tok:douwe egberts|koffie|500"}),
    ({"n": "Vanaf -20% korting chips"}, None),
    ({"n": None}, None),
    ({"n": "Kaas jong", "b": EAN}, {"ik": f"ean:{EAN}", "b": EAN}),
    ({"n": "Kaas jong", "b": "123"}, {"b": "123"}),
    ({"n": "kaas jong", "bn": "  "}, {"ik": "tok:unknown|jong-kaas|na", "s": "stuk"}),
]


@pytest.mark.parametrize("entry,want", SANITIZED)
def test_sanitize(spark, entry, want):
    df = spark.createDataFrame([tuple(entry.get(k) for k in ("n", "s", "b", "bn"))], "n string, s string, b string, bn string")
    got = sanitize.sanitize(sanitize.with_product_columns(df)).collect()
    if want is None:
        assert not got
        assert sanitize.rejected(df).count() == 1
    else:
        assert {k: got[0][k] for k in want} == want


def test_sanitize_twice_is_the_same(spark):
    df = spark.createDataFrame([("Campina halfvolle melk 1 l", "1 l"), ("Unox soep 2e halve prijs", "4 x 300 ml"), ("Kaas", "per stuk")], "n string, s string")
    once = sanitize.sanitize(sanitize.with_product_columns(df))
    cols = ["ik", "cn", "s", "wg"]
    assert sorted(map(tuple, once.select(cols).collect())) == sorted(map(tuple, sanitize.sanitize(once).select(cols).collect()))


def test_enrich_keeps_rejected_rows(spark):
    df = spark.createDataFrame([("x", "Nu voor 2.99", "Nu voor 2.99", None), ("y", "Kaas", "Kaas", "Bakery")], "image string, raw_text string, n string, category string")
    rows = {r["n"]: r for r in sanitize.enrich(df).collect()}
    assert rows["Nu voor 2.99"]["ik"] is None and rows["Kaas"]["c"] == "Bakery"


def test_backfill(spark):
    df = spark.createDataFrame([("", f'{{"ean": "{EAN}"}}'), ("1", f'{{"ean": "{EAN}"}}'), (None, "{}")], "b string, j string").withColumn("_row", F.parse_json("j"))
    assert [(r["b"], r["_added"]) for r in sanitize.backfill_barcodes(df).collect()] == [(EAN, True), ("1", False), (None, False)]


def health_rows(spark):
    rows = [("One", "1.25", "one", EAN, "2026-07-10T12:00:00Z"), ("Two", "999", "two", EAN, None), ("Three", "bad", "two", "123", None)]
    df = spark.createDataFrame(rows, "n string, p string, ik string, b string, scraped_at string")
    return df.withColumns({"country": F.lit("nl"), "store": F.lit("x"), "scraped": health.scrape_time(F.col("scraped_at"))})


def test_health(spark):
    now = F.lit(dt.datetime(2026, 7, 10, 13, tzinfo=dt.UTC))
    got = health.issues(health.metrics(health_rows(spark), now)).first()
    want = {"product_count": 3, "valid_barcodes": 2, "invalid_barcodes": 1, "duplicate_barcodes": 1, "conflicts": 1, "duplicate_identities": 1, "invalid_prices": 1, "suspicious_prices": 1, "missing_timestamps": 2, "barcode_coverage": 0.666667, "status": "error"}
    assert {k: got[k] for k in want} == want
    codes = ["invalid_price_rate_high", "suspicious_price_rate_high", "duplicate_identity_rate_high", "duplicate_barcode_rate_high", "barcode_identity_conflicts", "invalid_barcodes", "missing_scrape_timestamps"]
    assert [i["code"] for i in got["issues"]] == codes
    top = health.rollup(health.issues(health.metrics(health_rows(spark), now))).first()
    assert (top["stores"], top["error"], top["products"], top["status"]) == (1, 1, 3, "error")
    assert [health.exit_code("warning", x) for x in ("error", "warning", "never")] == [0, 1, 0]


def test_quality(spark):
    rows = [("a", "0.00", None, None, 0), ("b", "1", "u", "a", 5), ("Kaas jong", " ", "u", "a", None)]
    df = spark.createDataFrame(rows, "n string, p string, l string, ik string, wg long").withColumns({"country": F.lit("nl"), "store": F.lit("x"), "b": F.lit(""), "bn": F.lit("q"), "i": F.lit("")})
    stores = spark.createDataFrame([("nl", "x"), ("nl", "y")], "country string, store string")
    rows = {r["store"]: r.asDict() for r in quality.quality(df, stores=stores).collect()}
    want = {"total": 3, "with_barcode": 0, "with_identity": 2, "with_brand": 3, "with_weight": 1, "promo_in_name": 2, "missing_price": 2, "missing_url": 1, "duplicate_identity": 1}
    assert {k: rows["x"][k] for k in want} == want
    assert rows["y"]["total"] == 0
    assert "| nl | x | 3 |" in quality.markdown(quality.quality(df, stores=stores))


def test_drift(spark):
    t = spark.createDataFrame([("nl", "a", 0), ("nl", "b", 0), ("nl", "c", 80)], "country string, store string, minimum_products int")
    n = spark.createDataFrame([("nl", "a", 50), ("nl", "b", 49)], "country string, store string, count long")
    base = spark.createDataFrame([("nl", "a", 100), ("nl", "b", 100), ("nl", "c", 900)], "country string, store string, total long")
    both = drift.against_baseline(t, n, base)
    got = {r["store"]: r["failure"] for r in drift.drop_gate(both).collect()}
    assert got["a"] is None and "dropped 51%" in got["b"] and "minimum 80" in got["c"]
    assert {r["baseline"] for r in drift.against_baseline(t, n, base, baseline_by=["store"]).collect()} == {100, 900}
    seen = both.withColumns({"read_error": F.lit(None).cast("string"), "changed_at": F.lit(0), "catalog": F.lit("x.json")})
    out = {r["store"]: r["alerts"] for r in drift.alerts(seen, F.lit(1000)).collect()}
    assert out["a"] == ["catalog has not changed for infh (limit 72h)"] and len(out["c"]) == 3
    assert drift.annotations(drift.alerts(seen, F.lit(1000))).count() == 6


def test_gates(spark):
    log = spark.createDataFrame([("u", None)] * 19 + [("v", "e")], "url string, error string")
    assert drift.failure_gate(log).first()["passed"] and not drift.failure_gate(log, max_ratio=0.01).first()["passed"]
    with pytest.raises(ValueError):
        drift.require(drift.minimum_gate(log, ["url"], 2), "too few rows")


def test_sets(spark):
    df = spark.createDataFrame([(0, "ACTIE x"), (1, "actie"), (2, None)], "_ord int, t string")
    hit, rest = sets.split_by_keywords(df, "t", ["ACTIE"])
    assert hit.count() == 1 and rest.count() == 2
    assert sets.union_branches(rest, hit.withColumn("z", F.lit(1))).filter("_branch = 1").first()["z"] == 1
    paths = lambda x: spark.createDataFrame([(p,) for p in x], "path string")
    assert [r["path"] for r in sets.removable_paths(paths("bbac"), paths("c")).collect()] == ["a", "b"]
    nested = sets.nested(spark.createDataFrame([("s", 2, "y"), ("s", 1, "x")], "n string, o int, v string"), ["n"], "o").first()
    assert [x["v"] for x in nested["d"]] == ["x", "y"]


def test_small_gates(spark):
    from cardamom.functions import text as T

    report = spark.createDataFrame([("nl", "lidl", 2), ("nl", "plus", 5), ("nl", "dirk", 0)], "country string, store string, promo_in_name long")
    assert quality.promo_gate(report).count() == 1 and quality.promo_gate(report, "dirk").count() == 0
    df = spark.createDataFrame([("bbq", "x/y"), ("kaas", "x/seizoen"), ("kaas", "x"), (None, None)], "n string, u string")
    assert [r[0] for r in df.select(T.is_optional_category(F.col("n"), F.col("u"), ["bbq"], ["seizoen"])).collect()] == [True, True, False, False]


def test_price_parsers_matches_its_sql_where_values_are_zero_or_null(spark, tmp_path):
    import duckdb

    from cardamom.plans.catalog_queries import ORACLE, QUERIES

    values = [0.0, 0.004, 0.005, 1.0, 2.675, 1234567.891, None]
    rows = [(5 * k + rest, v) for k, v in enumerate(values) for rest in range(5)]
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
        want = con.execute(ORACLE["price_parsers"]).fetchall()
    got = [tuple(r) for r in QUERIES["price_parsers"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_price_parsers_matches_its_sql_where_values_are_negative_or_not_finite(spark, tmp_path):
    import duckdb

    from cardamom.plans.catalog_queries import ORACLE, QUERIES

    values = [-1.5, -0.004, -1234567.891, 2.5, 1e18, float("inf"), float("-inf"), float("nan"), None]
    rows = [(sign * (5 * k + rest), v) for k, v in enumerate(values) for rest in range(5) for sign in (1, -1)] + [(None, v) for v in values]
    spark.createDataFrame(rows, "event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
        want = con.execute(ORACLE["price_parsers"]).fetchall()
    got = [tuple(r) for r in QUERIES["price_parsers"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
