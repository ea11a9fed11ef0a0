import json

import pytest
from pyspark.sql import functions as F

from cardamom import cli
from cardamom.operators import sanitize
from cardamom.plans import pipeline
from cardamom.sources import json_catalog, payloads, sinks, stores
from cardamom.streaming import cards as streaming

EAN = "4006381333931"


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    path.write_text(data if isinstance(data, str) else json.dumps(data))
    return str(path)


def test_mixed_array_and_fragments(spark, tmp_path):
    a = put(tmp_path / "a.json", [{"n": "Kaas", "x": 1}, 3, "s", None])
    b = put(tmp_path / "b.json", {"raw_text": "one"})
    c = put(tmp_path / "c.json", "{bad")
    rows = json_catalog.read_catalog(spark, a).orderBy("_ord").collect()
    assert [r["_is_object"] for r in rows] == [True, False, False, False] and rows[0]["n"] == "Kaas"
    cards = json_catalog.read_cards(spark, a, b, c)
    assert sorted(str(r["raw_text"]) for r in cards.collect()) == ["None", "one"]
    reasons = {r["path"].rsplit("/", 1)[1]: (r["count"], r["read_error"]) for r in json_catalog.read_reasons(json_catalog.scan_files(spark, a, b, c)).collect()}
    assert reasons == {"a.json": (4, None), "b.json": (0, "catalog root is not a JSON array"), "c.json": (0, "catalog is unreadable")}
    with pytest.raises(ValueError):
        json_catalog.require_fragments(json_catalog.scan_files(spark, a), 10)


CONFIG = {"default_country": "nl", "countries": {"nl": {"label": "N", "locale": "nl", "currency": "EUR", "stores": {s: {"display_name": s, "dir": f"d/{s}", "catalog": "c.json", "minimum_products": 1, "pipeline": ["a"], "intermediate_globs": ["*.json"]} for s in ("plus", "coop")}}, "de": {"label": "D", "locale": "de", "currency": "EUR", "stores": {}}}}


def test_stores_and_cli(spark, tmp_path, capsys):
    config = put(tmp_path / "stores.json", CONFIG)
    dim = stores.read_stores(spark, config)
    assert [r["catalog_path"] for r in dim.orderBy("_store_ord").collect()] == ["d/plus/c.json", "d/coop/c.json"]
    assert stores.one_store(dim, "nl", "plus")["minimum_products"] == 1 and stores.countries(dim) == ["nl"]
    with pytest.raises(KeyError):
        stores.one_store(dim, "nl", "nope")
    assert stores.intermediate_globs(dim).count() == 2 and stores.select(dim, store="coop").count() == 1
    put(tmp_path / "d/plus/c.json", [{"n": "Kaas", "p": "1", "ik": "a", "b": EAN, "l": "u"}])
    put(tmp_path / "d/coop/c.json", [])
    args = ["--root", str(tmp_path), "--config", config]
    assert cli.main(["quality", *args]) == 0 and "| nl | plus | 1 |" in capsys.readouterr().out
    assert cli.main(["validate", *args]) == 1 and "NL/coop: 0 products" in capsys.readouterr().out
    assert cli.main(["alerts", *args]) == 1 and "zero products" in capsys.readouterr().out
    assert cli.main(["health", *args, "--fail-on", "never", "--output", str(tmp_path / "health.json")]) == 0
    assert json.loads((tmp_path / "health.json").read_text())[0]["store"] == "plus"


def test_commands_that_change_catalogs(spark, tmp_path, capsys):
    config = put(tmp_path / "stores.json", CONFIG)
    args = ["--root", str(tmp_path), "--config", config]
    plus, coop = tmp_path / "d/plus/c.json", tmp_path / "d/coop/c.json"
    put(plus, json.dumps([{"n": "Hero jam", "p": "1,50", "s": "200 g", "ean": EAN}, {"n": "Hero jam", "p": "1,20", "s": "200 g", "ean": EAN}, {"n": "x", "p": "1"}], indent=2))
    put(coop, [{"n": "Hero jam", "p": "2", "s": "200 g", "b": EAN}, {"n": "Hero drop", "p": "2", "s": "1 kg"}])
    read = lambda p: json.loads(p.read_text())

    assert cli.main(["backfill", *args]) == 0 and "all/all: 3 barcodes" not in capsys.readouterr().out
    assert [r.get("b") for r in read(plus)] == [EAN, EAN, None]
    assert cli.main(["sanitize", *args, "--rejects", str(tmp_path / "bad")]) == 0
    out = capsys.readouterr().out
    assert "nl/plus: 3 rows, 1 kept" in out and "nl/coop: 2 rows, 1 kept" in out and "all/all: 5 rows, 2 kept" in out
    assert [(r["n"], r["p"], r["ik"]) for r in read(plus)] == [("Hero Jam", "1,20", f"ean:{EAN}")] and [r["n"] for r in read(coop)] == ["Hero Drop"]
    assert spark.read.json(str(tmp_path / "bad")).count() == 1
    put(coop, [{"n": "Hero Jam", "ik": f"ean:{EAN}"}, {"n": "Hero Drop", "ik": "z"}])
    assert cli.main(["overlap", *args]) == 0 and "nl/coop: 2 rows, 1 kept" in capsys.readouterr().out
    assert [r["n"] for r in read(coop)] == ["Hero Drop"]

    assert cli.main(["run", *args, "--store", "coop"]) == 1 and "scan: " in capsys.readouterr().out and len(read(coop)) == 1
    put(tmp_path / "d/coop/new_results/1.json", [{"raw_text": "Kaas jong\n2,50\n200 g", "image": "i"}, {"raw_text": "Kaas jong\n3,50"}])
    assert cli.main(["run", *args, "--store", "coop"]) == 0 and "write: done" in capsys.readouterr().out
    assert [(r["n"], r["p"]) for r in read(coop)] == [("Kaas Jong", "2.50")]

    put(tmp_path / "d/coop/left.json", [])
    assert cli.main(["prune", *args, "--dry-run"]) == 0 and "d/coop/left.json" in capsys.readouterr().out and (tmp_path / "d/coop/left.json").exists()
    assert cli.main(["prune", *args]) == 0 and not (tmp_path / "d/coop/left.json").exists() and coop.exists() and plus.exists()
    assert cli.main(["alerts", *args, "--summary", str(tmp_path / "s.md")]) == 0 and "| nl/plus | 1 | 0 | none |" in (tmp_path / "s.md").read_text()
    assert cli.main(["health", *args, "--fail-on", "never"]) == 0 and "STORE" in capsys.readouterr().out


def test_steps_end_at_the_first_failure():
    seen = []
    done, error = pipeline.run_steps([("a", lambda: seen.append(1)), ("b", lambda: 1 / 0), ("c", lambda: seen.append(2))])
    assert done == ["a"] and error[0] == "b" and isinstance(error[1], ZeroDivisionError) and seen == [1]


def test_baseline(spark, tmp_path):
    path = put(tmp_path / "q.json", [{"store": "a", "total": 5}, {"country": "de", "store": "b"}, {"total": 1}, 4])
    assert sorted(map(tuple, json_catalog.read_baseline(spark, path).collect())) == [("de", "b", 0), ("nl", "a", 5)]
    assert json_catalog.read_baseline(spark, None).count() == 0


def one(spark, f, data):
    return spark.createDataFrame([(json.dumps(data),)], "j string").select(f(F.parse_json("j")).alias("c")).first()["c"]


def test_payloads(spark):
    ah = one(spark, payloads.ah_card, {"title": "Melk", "brand": " AH ", "currentPrice": 1.25, "isBonus": True, "priceBeforeBonus": 2, "salesUnitSize": "1 l", "images": [{"href": "h"}], "gtin13": EAN})
    assert (ah["raw_text"], ah["image"], ah["barcode"]) == ("AH Melk\nvan 2,00\n1,25\n1 l", "h", EAN)
    assert one(spark, payloads.ah_card, {"title": "T", "currentPrice": 0, "priceBeforeBonus": 3, "webshopId": EAN})["raw_text"] == "T\n3,00"
    assert one(spark, payloads.ah_child_ids, {"filters": [{"id": "x"}, {"id": "taxonomy", "options": [{"id": 7}, {"id": ""}]}]}) == ["7"]
    jumbo = one(spark, payloads.jumbo_card, {"title": "Cola", "prices": {"price": 199, "promoPrice": 0}, "promotions": [{"tags": [{"text": "2 voor"}]}], "link": "l"})
    assert (jumbo["raw_text"], jumbo["link"]) == ("Cola\n2 voor\nPrijs: € 0,00", "l")
    data = {"ProductList": {"List": [{"PLP_Str": {"Name": "N", "OriginalPrice": "2", "EAN": EAN, "Slug": "s"}}, {"PLP_Str": 3}, {"Name": "M", "NewPrice": "0", "OriginalPrice": "1.5", "Product_Code": EAN}, {}]}}
    df = spark.createDataFrame([(json.dumps(data),)], "j string").withColumn("v", F.parse_json("j"))
    rows = payloads.plus_products(df, "v", "https://p").orderBy(F.desc("raw_text")).collect()
    assert [(r["raw_text"], r["barcode"], r["link"]) for r in rows] == [("N\n2,00", EAN, "https://p/producten/s"), ("M\n1,5", None, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False)], "a int, _ok boolean")
    path = str(tmp_path / "t")
    sinks.overwrite(df, path)
    sinks.overwrite(spark.read.parquet(path).filter("a = 2"), path)
    assert spark.read.parquet(path).count() == 1
    sinks.json_array(df, str(tmp_path / "x.json"), "a")
    assert json.loads((tmp_path / "x.json").read_text()) == [{"_ok": True}, {"_ok": False}]
    assert sinks.with_rejects(df, str(tmp_path / "k"), str(tmp_path / "r")) == {"input": 2, "kept": 1, "rejected": 1}
    assert (tmp_path / "r").exists()
    sinks.with_rejects(df.filter("_ok"), str(tmp_path / "k"), str(tmp_path / "r"))
    assert not (tmp_path / "r").exists()


def test_store_pipeline_and_postprocess(spark):
    cards = spark.createDataFrame([(0, "1\n99\nMelk\n1 l", "i"), (1, "ACTIE\n99\nChips\n200 g", "i"), (2, "2\n50\nMelk\n1 l", "i")], "_ord long, raw_text string, image string")
    rows = {r["n"]: r["p"] for r in pipeline.store_catalog(cards, "dirk").collect()}
    assert rows == {"Melk": "1.99", "Chips": "0.99"}
    raw = spark.createDataFrame([(0, "nl", "plus", "Unox soep"), (1, "nl", "plus", "unox soep"), (0, "nl", "coop", "Unox soep"), (1, "nl", "coop", "Brood wit"), (2, "nl", "coop", "Bij")], "_ord long, country string, store string, n string")
    raw = sanitize.with_product_columns(raw)
    dim = spark.createDataFrame([("nl", "plus", 1), ("nl", "coop", 5)], "country string, store string, minimum_products int")
    base = spark.createDataFrame([("nl", "plus", 10)], "country string, store string, total long")
    out = pipeline.postprocess(raw, dim, base, F.current_timestamp())
    assert sorted((r["store"], r["n"]) for r in out["rows"].collect()) == [("coop", "Brood Wit"), ("plus", "Unox Soep")]
    assert {r["store"]: r["failure"] is None for r in out["gate"].collect()} == {"plus": False, "coop": False}
    late = pipeline.postprocess(raw, dim, base, F.current_timestamp(), baseline_first=False)
    assert {r["store"]: r["failure"] is None for r in late["gate"].collect()} == {"plus": True, "coop": False}
    assert pipeline.totals(raw, out["rows"]).filter("country is null").first()["kept"] == 2


def test_streaming(spark, tmp_path):
    spark.range(10).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id")).alias("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, ts timestamp").parquet(str(tmp_path / "in"))
    seen = []
    q = streaming.persist(streaming.unseen(stream, ["k"], "ts"), lambda df, n: seen.extend(df.collect()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(r["k"] for r in seen) == [0, 1, 2]


def test_registered_queries(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
