import pytest
from pyspark.sql import functions as F

from cardamom.functions import barcode as B
from cardamom.functions import category as C
from cardamom.functions import identity as I
from cardamom.functions import price as P
from cardamom.functions import text as T

INF = float("inf")


def values(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"k int, x {kind}")
    return [r["y"] for r in df.select("k", f(F.col("x")).alias("y")).orderBy("k").collect()]


@pytest.mark.parametrize(
    "f,cases",
    [
        (B.normalize_barcode, {"4006381333931": "4006381333931", "4006381333932": None, "036000291452": "0036000291452", "96385074": "96385074", "04006381333931": None, " 4006-381333931 ": "4006381333931", "": None, None: None}),
        (I.parse_size, {"500 g": 500, "1,5 l": 1500, "6 x 330 ml": 1980, "4 x 1,5 l": 6000, "1 kg": 1000, "250gram": 250, "per 500 g": 500, "6 stuks": 6, "per stuk": 1, "33 cl": None, "": None, None: None, "2.5 ml": 2}),
        (P.loose_price, {"1,29": 1.29, "€ 2.50": 2.5, "0": 0.0, "": INF, "bad": INF, None: INF}),
        (P.strict_price, {"1,25": 1.25, "€ 2.50": None, "0": None, "1e3": 1000.0, "nan": None, "inf": None, "1d": None, " 2.5 ": 2.5, None: None}),
        (I.reject_reason, {"ab": "name_too_short", "Kaas": None, "Bij": r"reject_pattern:^\s*bij\s*$", "Nu voor 2.99": r"reject_pattern:^nu voor\b", None: "name_too_short"}),
        (C.from_url, {"https://x.nl/producten/pasta-rijst-internationale-keuken": "Frozen Foods", "/producten/koffie-en-thee/": "Beverages", "/producten/huisdier": "Other", "": "Other"}),
        (C.from_dotted_url, {"https://x.nl/categorie/boodschappen.fruit.appels?p=1": "Fruits & Vegetables"}),
        (C.from_name, {"SPF50 spray": "Personal Care", "Afwasmiddel citroen": "Household", "Shampoo mild": "Personal Care", "Prijs": "Frozen Foods"}),
        (C.from_key, {"vleeswaren": "Meat & Seafood", "huisdier": "Other", "verse_kaas": "Dairy & Eggs", "?": "Other"}),
        (P.whole_to_cents, {"85": "0.85", "5": "0.05", "199": "0.199", "1.99": "1.99", "": ""}),
        (P.comma_price, {"2": "2,00", "2.5": "2,5", "0": "", "": "", None: ""}),
        (T.strip_promo, {"Vanaf -20% korting chips": "", "Kaas voor met lidl plus 2": "Kaas", "Cola  1 + 1 gratis": "Cola", "Bier -30 %": "Bier"}),
        (T.capitals, {"2e coca-cola light": "2e coca-cola Light"}),
        (T.taxonomy_id, {"https://x/producten/1234/kaas": "1234", "https://x/": None}),
        (T.is_generic_listing, {"https://x.nl/producten/": True, "https://x.nl": True, "https://x.nl/producten/kaas": False}),
        (T.is_category_page, {"https://x.nl/producten/kaas/": True, "https://x.nl/producten/": False, "https://x.nl/a": False}),
        (lambda c: T.drop_param(c, "pagina"), {"https://x/a?pagina=2&b=1": "https://x/a?b=1", "https://x/a?pagina=2": "https://x/a", "https://x/a?b=1&pagina=3": "https://x/a?b=1"}),
        (I.extract_brand, {"Campina melk": "campina", "Douwe Egberts koffie": "douwe egberts", "een Vleugel kip": "vleugel", "een kip": None}),
        (B.barcode_in_text, {"x 4006381333931 y": "4006381333931", "12345": None}),
    ],
)
def test_scalar(spark, f, cases):
    assert values(spark, f, list(cases)) == list(cases.values())


def test_size_label(spark):
    df = spark.createDataFrame([(500, ""), (1000, ""), (1500, ""), (1980, ""), (1005, ""), (1, ""), (None, ""), (None, " 33  cl ")], "a long, s string")
    got = [r[0] for r in df.select(I.size_label(F.col("s"), F.col("a"))).collect()]
    assert got == ["500 ml", "1 l", "1.50 l", "1.98 l", "1 l", "1 stuk", "stuk", "33 cl"]


def test_tokens_and_keys(spark):
    df = spark.createDataFrame([("Campina halfvolle melk 1 l", "campina"), ("de van", None)], "n string, b string")
    rows = df.select(I.tokens(F.col("n"), F.col("b")).alias("t"), "n", "b")
    rows = rows.select("t", I.canonical_name(F.col("n"), F.col("b"), F.col("t")).alias("cn"), I.identity_key(F.lit(None).cast("string"), F.col("b"), F.col("t"), F.lit(5)).alias("ik")).collect()
    assert [tuple(r) for r in rows] == [(["halfvolle", "melk"], "campina halfvolle melk", "tok:campina|halfvolle-melk|5"), ([], "de van", "tok:unknown|unknown|5")]


def test_labelled_barcode_reads_labels_only(spark):
    ean = "4006381333931"
    cases = [
        (f'{{"image": "https://x/{ean}.png", "raw_text": "{ean}"}}', None),
        (f'{{"gtin13": "{ean}"}}', ean),
        (f'{{"webshopId": "{ean}"}}', None),
        (f'{{"product": {{"ean": {ean}}}}}', ean),
        (f'{{"eans": ["1", {{"value": "{ean}"}}]}}', ean),
        ("[1]", None),
        ("null", None),
    ]
    df = spark.createDataFrame(cases, "j string, want string")
    for r in df.select(B.labelled_barcode(F.try_parse_json("j")).alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_card_barcode(spark):
    df = spark.createDataFrame([(None, None, None, ["bad", "[1]", '{"gtin8": "96385074"}']), ("4006381333931", None, None, [])], "e string, g string, p string, s array<string>")
    got = [r[0] for r in df.select(B.card_barcode(F.col("e"), F.col("g"), F.col("p"), F.col("s"))).collect()]
    assert got == ["96385074", "4006381333931"]


def test_sql_functions(spark):
    from cardamom.functions.sqlfns import register

    assert "loose_price" in register(spark)
    row = spark.sql("SELECT loose_price('€ 2,50') a, strict_price('1,25') b, whole_to_cents('5') c, category_slug('A_b,c') d, normalize_barcode('036000291452') e, strict_price('x') f").first()
    assert tuple(row) == (2.5, 1.25, "0.05", "a-b-c", "0036000291452", None)
