"""Word lists, patterns and tables that results depend on."""

# Names that are no products: patterns, tried in this order, any case.
REJECT_PATTERNS = (
    r"prijsvoorbeeld",
    r"actieprijzen\s+vari",
    r"in verschillende varianten",
    r"\ball[e]?\s+.+\s+voor\b",
    r"\bvanaf\s*-?\d+\s*%",
    r"alleen in de winkel vanaf",
    r"^\s*bij\s*$",
    r"^\s*bij\s+\d",
    r"^\d+[.,]\d{2}\s*(euro|eur)?\s*$",
    r"^nu voor\b",
)

# A name ends where one of these begins; cut in this order.
PROMO_FRAGMENTS = ("vanaf -", "vanaf ", "prijsvoorbeeld", "actieprijzen", "alleen in de winkel", "met lidl plus", "voor eur ", " in verschillende varianten", "goedkoper")

# Removed from names afterwards, in this order; the flag says whether case counts.
PROMO_REMOVALS = (
    (r"\bvoor\s+met\s+lidl\s+plus\b.*$", False),
    (r"\bvoor\s+eur\b.*$", False),
    (r"\s*-\d+\s*%\s*$", True),
    (r"\b\d+\s*%\s*korting\b", False),
    (r"\b2e\s+halve\s+prijs\b", False),
    (r"\b1\s*\+\s*1\s*gratis\b", False),
    (r"\s+voor\s*$", False),
)

STOP_WORDS = ("per", "stuk", "stuks", "st", "st.", "voor", "eur", "euro", "de", "het", "een", "en", "met", "van", "voordeel", "voordeelverpakking", "voordeelpak", "verpakking", "pak", "nieuw", "prijs", "actie", "aanbieding", "gratis", "op=op", "online", "alleen", "winkel")
STORE_TOKENS = ("ah", "jumbo", "plus", "dirk", "lidl", "aldi", "coop", "huismerk", "1e", "prijs")

# Brands of several words, tried in this order, then single words.
PHRASE_BRANDS = ("cote d or", "côte d or", "douwe egberts", "old amsterdam", "red bull", "ben jerry", "ben & jerry", "grand italia", "la vache qui rit")
BRANDS = (
    "campina", "melkunie", "arla", "optimel", "sensodyne", "prodent", "aquafresh", "signal", "colgate", "milka", "cote", "dor", "unox", "knorr", "maggi",
    "heinz", "calve", "honig", "jumbo", "ah", "plus", "coca", "cola", "pepsi", "fanta", "spa", "heineken", "amstel", "grolsch", "douwe", "egberts",
    "lavazza", "nescafe", "bolletje", "wasa", "lu", "bastogne", "hero", "bonduelle", "iglo", "ola", "ben", "jerry", "hak", "grand", "italia", "mutti",
    "barilla", "nivea", "dove", "axe", "gillette", "always", "libresse", "pampers", "nappy", "nutrilon", "friso", "babybel", "philadelphia", "boursin",
    "galbani", "leerdammer", "old", "amsterdam", "liga", "sportlife", "redband", "mars", "snickers", "twix", "haribo", "red", "bull", "innocent",
)

CATEGORIES = ("Fruits & Vegetables", "Dairy & Eggs", "Meat & Seafood", "Beverages", "Bakery", "Snacks", "Frozen Foods", "Pantry", "Personal Care", "Household", "Other")
OTHER = "Other"
CATEGORY_OF_KEY = {
    "groente_aardappelen": "Fruits & Vegetables",
    "fruit_verse_sappen": "Fruits & Vegetables",
    "maaltijden_salades": "Pantry",
    "vegetarisch_vegan_en_plantaardig": "Pantry",
    "vlees": "Meat & Seafood",
    "vleeswaren": "Meat & Seafood",
    "bakkerij": "Bakery",
    "zuivel": "Dairy & Eggs",
    "glutenvrij": "Pantry",
    "borrel_chips_snacks": "Snacks",
    "pasta_rijst_wereldkeuken": "Pantry",
    "soepen_sauzen_kruiden_olie": "Pantry",
    "koek_snoep_chocolade": "Snacks",
    "ontbijtgranen_beleg": "Pantry",
    "tussendoortjes": "Snacks",
    "diepvries": "Frozen Foods",
    "koffie_thee": "Beverages",
    "frisdrank_sappen_water": "Beverages",
    "bier_wijn_aperitieven": "Beverages",
    "drogisterij": "Personal Care",
    "gezondheid_en_sport": "Personal Care",
    "huishouden": "Household",
    "baby_en_kind": "Personal Care",
    "huisdier": "Other",
    "koken_tafelen_vrije_tijd": "Household",
    "ah_voordeelshop": "Other",
}
# The first rule with a word that the path holds decides.
CATEGORY_RULES = (
    (("drogisterij", "baby", "verzorging", "zonnebrand", "douche", "shampoo"), "Personal Care"),
    (("huishoud", "wasmiddel", "schoonmaak", "toiletpapier"), "Household"),
    (("diepvries", "frozen", "ijs"), "Frozen Foods"),
    (("zuivel", "melk", "kaas", "eieren", "boter", "yoghurt", "kwark"), "Dairy & Eggs"),
    (("vlees", "vis", "kip", "gehakt", "rundvlees", "varkensvlees", "zalm", "tonijn"), "Meat & Seafood"),
    (("fruit", "groente", "aardappel", "salade", "sla", "tomaten"), "Fruits & Vegetables"),
    (("brood", "bakkerij", "gebak", "bolletje", "croissant", "beschuit"), "Bakery"),
    (("chips", "koek", "snoep", "chocolade", "chocola", "snack"), "Snacks"),
    (("bier", "wijn", "frisdrank", "sap", "koffie", "thee", "drank"), "Beverages"),
    (("pasta", "rijst", "conserven", "soep", "saus", "wereldkeuken", "ontbijt", "beleg"), "Pantry"),
)
CARE_WORDS = ("zonnebrand", "sun protection")
HOUSEHOLD_WORDS = ("wasmiddel", "afwasmiddel", "toiletpapier", "keukenrol")
TOILETRY_WORDS = ("shampoo", "tandpasta", "deodorant", "douchegel")

# Labelled fields that may hold a barcode, in order of preference.
BARCODE_FIELDS = ("barcode", "barCode", "ean", "EAN", "ean8", "ean13", "gtin", "GTIN", "gtin8", "gtin12", "gtin13", "tradeItemNumber", "globalTradeItemNumber", "b")
BARCODE_LISTS = ("barcodes", "eans", "gtins", "tradeItemNumbers")

# Offer keywords of the layouts, as they meet lowered lines.
OFFERS_AH = ("nu voor", "korting", "actie", "van ", "voor ", "deal", "2 voor", "3 voor", "aanbieding", "probeer prijs", "sale", "special", "gratis")
OFFERS_JUMBO = ("nu voor", "korting", "actie", "deal", "2 voor", "3 voor", "aanbieding", "probeer prijs", "2 + 1 gratis", "1 + 1 gratis", "4 voor", "6 voor", "2 voor 6.00", "gratis", "3+1 gratis", "1+1 gratis", "gratis bezorging", "25 % korting", "15 % korting", "50 % korting", "1.00 korting", "2e 50% korting", "op=op", "2e halve prijs")
OFFERS_ALDI = ("in de aanbieding", "actie", "korting", "op=op", "probeer prijs")
OFFERS_DIRK = ("actie", "1+1", "2e", "%", "gratis", "vanaf")
OFFERS_DIRK_PROMO = ("actie", "van", "1+1", "2e", "%", "gratis", "vanaf")
OFFERS_LIDL = ("actie", "van", "korting", "1+1", "gratis", "probeer prijs", "tot", "-")
OFFERS_PLUS = ("nu voor", "2 voor", "3 voor", "4 voor", "6 voor", "aanbieding", "gratis", "3+1 gratis", "1+1 gratis", "gratis bezorging", "25 % korting", "15 % korting", "50 % korting", "1+2 gratis", "2+1 gratis", "1.00 korting", "2e 50% korting", "op=op", "2e halve prijs", "500 gram 4.99", "250 gram 2.69")
SIZES_ALDI = ("g", "kg", "l", "ml", "cl", "stuks", "doekjes", "tabs", "porties", "plakjes", "kopjes")
BRANDS_ALDI = ("trader joe's", "milsani", "goud gebakken", "cantolino", "steenbrugge", "molenland", "party gebak", "mama mancini", "de vleesmeesters", "bbq", "golden seafood", "mucci", "my vay")
NOTES_LIDL = (
    r"alleen in de winkel vanaf \d{2}/\d{2}",
    r"alleen in de winkel",
    r"vanaf \d{2}/\d{2}",
    r"vanaf \d{1,2}\s+[a-zA-Z]+",
    r"geldig tot \d{2}/\d{2}",
    r"geldig vanaf \d{2}/\d{2}",
    r"verkrijgbaar vanaf \d{2}/\d{2}",
    r"-\d+%\s*-\s*\d{2}/\d{2}",
    r"prijs\s+ca\.\s+\d+\s*g:\s*€\.?",
    r"-€\d+\.-",
    r"\d{2}/\d{2}\s*-\s*\d{2}/\d{2}",
    r"prijs\s+ca\.",
    r"\s*:\s*€\.?",
    r"-Є\d+\.-",
    r"\b(?:KILO|GRAM|LITER|STUKS)\b!?",
    r"\s*!+",
    r"(?<=[0-9])\s*(?:G|KG|ML|L|CL)\b",
)
NO_IMAGE = "/assets/img/not_available.svg"
# Literal strings cut from raw texts, by layout.
CUTS_ALDI = ("Barissimo\n\n", "Snack fan\n\n", "Potato king\n\n", "\nBoodschappenlijstje", "All seasons\n\n")
CUTS_PLUS = ("Uit de keuken van",)

# Thresholds of the health report.
HEALTH = {
    "stale_after_hours": 48,
    "warn_invalid_price_rate": 0.01,
    "max_invalid_price_rate": 0.10,
    "max_suspicious_price_rate": 0.02,
    "max_duplicate_identity_rate": 0.01,
    "max_duplicate_barcode_rate": 0.005,
    "minimum_barcode_coverage": 0.0,
}
PRICE_RANGE = (0.05, 500.0)
