import pytest
from pyspark.sql import functions as F

from cardamom.plans.layouts import LAYOUTS, parse_cards

CASES = [
    ("albert-heijn", "Kaas jong / van 3,50 / 2,60 / 200 g", ("Kaas jong", "2.60", "van 3,50", "200 g")),
    ("coop", "Kaas jong / van 3,50 / 2,60 / 200 g", ("Kaas jong", "2.60", "van 3,50", "200 g")),
    ("albert-heijn", "Kaas jong / 2 voor 3,50", ("Kaas jong", "", "2 voor 3,50", "")),
    ("albert-heijn", "Brood / 1,50 / 2,75", ("Brood", "2.75", "", "")),
    ("albert-heijn", "250 g / Boter / 1,50", ("Boter", "1.50", "", "250 g")),
    ("jumbo", "Halfvolle melk 1L 123 / Prijs: € 1,29", ("Halfvolle melk 1", "1.29", "", "1L")),
    ("jumbo", "abcd / actie nu / 2,00", ("abc", "2.00", "actie nu", "")),
    ("jumbo", "abc", ("a", "", "", "")),
    ("jumbo", "ab", ("", "", "", "")),
    ("aldi", "In de aanbieding / MILSANI / Halfvolle melk / 1 l / 0.99", ("Halfvolle melk", "0.99", "In de aanbieding", "1 l")),
    ("aldi", "Inhoud: 6 Stuks / Eieren / 1.99", ("Eieren", "1.99", "", "6 stuks")),
    ("dirk", "1 / 99 / Melk / 1 l", ("Melk", "1.99", "", "1 l")),
    ("dirk", "85 / Cola / 2e gratis / 1 l / gratis ijs", ("Cola gratis ijs", "85", "2e gratis", "1 l")),
    ("dirk-promo", "ACTIE / 99 / Chips / 200 g", ("Chips", "0.99", "ACTIE", "200 g")),
    ("dirk-promo", "1 / 2 / 3 / Thee", ("Thee", "", "", "")),
    ("lidl", "Kaas / -20% / 1.99 / 200 g", ("Kaas 200", "1.99", "-20%", "200 G")),
    ("plus", "Halfvolle melk / Per 1 l / 1,29", ("Halfvolle melk", "1.29", "", "Per 1 l")),
    ("plus", "1+1 gratis / Cola / 500 ml / 1,99", ("Cola", None, "1+1 gratis", "500 ml")),
]


@pytest.mark.parametrize("layout,text,want", CASES)
def test_layout(spark, layout, text, want):
    df = spark.createDataFrame([(text.replace(" / ", "\n"), "x.png")], "raw_text string, image string")
    r = parse_cards(df, layout).first()
    for got, expected in zip((r["n"], r["p"], r["o"], r["s"]), want, strict=True):
        if expected is not None:
            assert got == expected
    assert r["l"] == "x.png"


def test_empty_and_null_cards(spark):
    df = spark.createDataFrame([("", None), (None, None), (" \n \t", "y")], "raw_text string, image string")
    for layout in LAYOUTS:
        rows = parse_cards(df, layout).select("n", "p", "o", "s").collect()
        assert {tuple(r) for r in rows} == {("", "", "", "")}, layout


def test_placeholder_image(spark):
    df = spark.range(1).select(F.lit("Kaas").alias("raw_text"), F.lit("/assets/img/not_available.svg").alias("image"))
    assert parse_cards(df, "albert-heijn").first()["l"] == ""
