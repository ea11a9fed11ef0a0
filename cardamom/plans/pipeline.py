"""Whole runs: cards of a store to its catalog; all catalogs to clean ones; reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import constants as K
from cardamom.functions.price import whole_to_cents
from cardamom.functions.text import cut_out
from cardamom.operators import dedupe, drift, health, quality, sanitize, sets
from cardamom.operators.overlap import without_overlap
from cardamom.plans.layouts import parse_cards

CUTS = {"aldi": K.CUTS_ALDI, "plus": K.CUTS_PLUS}


def store_catalog(cards: DataFrame, store: str, *, ord_col: str = "_ord", dedupe_names: bool | None = None) -> DataFrame:
    """The catalog of one store from its raw cards, as one lazy plan.

    The store albert-heijn keeps equal names unless ``dedupe_names`` says otherwise."""
    cards = cards.withColumn("raw_text", cut_out(F.col("raw_text"), CUTS.get(store, ())))
    if store == "dirk":
        promo, regular = sets.split_by_keywords(cards, "raw_text", ("PROBEER PRIJS", "ACTIE"))
        parts = [sanitize.enrich(parse_cards(regular, "dirk")), sanitize.enrich(parse_cards(promo, "dirk-promo"))]
        rows = sets.union_branches(*parts).withColumn("p", whole_to_cents(F.col("p")))
        ord_ = F.struct("_branch", ord_col)
        rows = rows.withColumn("_order", ord_)
        ord_col = "_order"
    else:
        rows = sanitize.enrich(parse_cards(cards, store))
        if store == "aldi":
            rows = rows.withColumns({"i": F.col("l"), "l": F.lit(None).cast("string")})
    return dedupe.keep_first_name(rows, ord_col=ord_col, enabled=store != "albert-heijn" if dedupe_names is None else dedupe_names)


def sanitize_all(rows: DataFrame, *, by: Sequence[str] = ("country", "store"), ord_col: str = "_ord", drop: str = "coop", against: str = "plus") -> DataFrame:
    """Clean rows of all stores: sanitised, the cheapest of each identity in each store, overlap removed.

    Rows of the store ``drop`` go if ``against``, of the same country, has them."""
    clean = dedupe.keep_cheapest(sanitize.sanitize(rows), ord_col=ord_col, within=by)
    country = next((c for c in by if c != "store"), None)
    keyed = clean.withColumns({f"_{k}": F.when(F.coalesce(k, F.lit("")) != "", F.concat_ws("\u0001", *([country] if country else []), k)) for k in ("ik", "b", "cn")})
    mine, others = keyed.filter(F.col("store") == drop), keyed.filter(F.col("store") != drop)
    kept = without_overlap(mine, keyed.filter(F.col("store") == against), ("_ik", "_b", "_cn"))
    return others.unionByName(kept).drop("_ik", "_b", "_cn")


def totals(before: DataFrame, after: DataFrame, by: Sequence[str] = ("country", "store")) -> DataFrame:
    """Rows in and kept for each store and over all (null keys)."""
    a = before.rollup(*by).agg(F.count("*").alias("input"))
    b = after.rollup(*by).agg(F.count("*").alias("kept"))
    on = None
    for c in by:
        eq = a[c].eqNullSafe(b[c])
        on = eq if on is None else on & eq
    return a.join(b, on, "left").select(*[a[c] for c in by], "input", F.coalesce("kept", F.lit(0)).alias("kept"))


def run_steps(steps: Sequence[tuple[str, Callable[[], object]]]) -> tuple[list[str], tuple[str, Exception] | None]:
    """Run the steps in order up to the first that raises: the names of those done, and the name and error of that one."""
    done: list[str] = []
    for name, step in steps:
        try:
            step()
        except Exception as e:  # a step may fail in any way; the caller reports it
            return done, (name, e)
        done.append(name)
    return done, None


def reports(rows: DataFrame, stores: DataFrame, now: Column) -> dict[str, DataFrame]:
    """Quality, health (with issues and status) and its rollup for catalogs of all stores."""
    scraped = health.scrape_time(*[F.col(c) for c in ("scrapedAt", "scraped_at") if c in rows.columns])
    m = health.metrics(rows.withColumn("scraped", scraped), now).join(stores.select("country", "store", "minimum_products"), ["country", "store"])
    judged = health.issues(m, minimum=F.col("minimum_products"))
    return {"quality": quality.quality(rows, stores=stores), "health": judged, "summary": health.rollup(judged)}


def postprocess(rows: DataFrame, stores: DataFrame, baseline: DataFrame, now: Column, *, baseline_first: bool = True) -> dict[str, DataFrame]:
    """Clean all catalogs, then report and gate them.

    ``baseline_first`` gates against the baseline as given; else against the new report, so no drop can show."""
    clean = sanitize_all(rows)
    out = reports(clean, stores, now) | {"rows": clean}
    counts = out["quality"].select("country", "store", F.col("total").alias("count"))
    old = baseline if baseline_first else out["quality"].select("country", "store", "total")
    out["gate"] = drift.drop_gate(drift.against_baseline(stores.select("country", "store", "minimum_products"), counts, old))
    return out
