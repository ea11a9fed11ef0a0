"""Command line: reports, gates and clean-up of catalogs on a store configuration.

health, validate, alerts and quality report; sanitize, backfill, overlap and prune change the files
of the chosen stores; run makes a store's catalog from its card fragments."""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.operators import drift, health, overlap, quality, sanitize, sets
from cardamom.plans import pipeline
from cardamom.session import session
from cardamom.sources import json_catalog, sinks, stores

COLUMNS = [*sanitize.PRODUCT, "scrapedAt"]


def load(spark: SparkSession, root: str, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(product rows, catalog files) of the stores whose file is there, with country and store."""
    keys = dim.select("country", "store", "catalog_path").collect()  # one row a store
    files = [f"{root}/{r['catalog_path']}" for r in keys]
    there = [f for f in files if sinks._fs(spark, f)[0].exists(sinks._fs(spark, f)[1])]
    if not there:
        raise FileNotFoundError(f"no catalog below {root}")
    named = dim.select("country", "store", "catalog_path")
    on = F.endswith(F.col("path"), F.concat(F.lit("/"), F.col("catalog_path")))
    scanned = json_catalog.scan_files(spark, *there)
    info = json_catalog.read_reasons(scanned).join(named, on)
    rows = json_catalog.typed(json_catalog.elements(scanned), json_catalog.PRODUCT | {"scrapedAt": "string"}).join(named, on)
    return rows, info


def rewrite(rows: DataFrame, root: str, dim: DataFrame) -> None:
    """Put the rows of each store in the place of its catalog."""
    for r in dim.select("country", "store", "catalog_path").collect():  # one row a store
        own = rows.filter((F.col("country") == r["country"]) & (F.col("store") == r["store"]))
        sinks.json_array(own.select(*[c for c in COLUMNS if c in own.columns], "_ord"), f"{root}/{r['catalog_path']}", "_ord")


def prune(spark: SparkSession, root: str, dim: DataFrame, dry: bool) -> list[str]:
    """Delete what the stores' intermediate globs match, but no catalog. Returns the paths, sorted."""
    globs = stores.intermediate_globs(dim.select("country", "store", F.expr("transform(intermediate_globs, g -> concat(dir, '/', g))").alias("intermediate_globs"))).collect()
    fs, top = sinks._fs(spark, root)
    found = [str(s.getPath().toUri().getPath()) for r in globs for s in (fs.globStatus(sinks._fs(spark, f"{root}/{r['glob']}")[1]) or ())]
    base = str(fs.makeQualified(top).toUri().getPath())
    canonical = dim.select(F.concat(F.lit(f"{base}/"), "catalog_path").alias("path"))
    gone = [r["path"] for r in sets.removable_paths(spark.createDataFrame([(p,) for p in found], "path string"), canonical).collect()]
    for path in gone if not dry else ():
        sinks.remove(spark, path)
    return gone


def clean(command: str, args: argparse.Namespace, spark: SparkSession, dim: DataFrame, rows: DataFrame) -> int:
    """The commands that change catalogs; prints rows before and after, by store and over all."""
    if command == "backfill":
        new = sanitize.backfill_barcodes(rows)
        for r in new.rollup("country", "store").agg(F.count_if("_added").alias("n")).orderBy("country", "store").collect():
            print(f"{r['country'] or 'all'}/{r['store'] or 'all'}: {r['n']} barcodes added")
        rewrite(new, args.root, dim)
        return 0
    if command == "overlap":
        own, other = (rows.filter(F.col("store") == s) for s in (args.drop, args.against))
        new = rows.filter(F.col("store") != args.drop).unionByName(overlap.without_overlap(own, other))
    else:
        kept = sanitize.classify(rows)
        if args.rejects:
            bad = kept.filter("not _ok and _is_object").drop("_ok")
            sinks.json_lines(bad.select("country", "store", *[c for c in COLUMNS if c in bad.columns]), args.rejects)
        new = pipeline.sanitize_all(rows, drop=args.drop, against=args.against)
    for r in pipeline.totals(rows, new).orderBy("country", "store").collect():
        print(f"{r['country'] or 'all'}/{r['store'] or 'all'}: {r['input']} rows, {r['kept']} kept")
    rewrite(new, args.root, dim)
    return 0


def run_store(args: argparse.Namespace, spark: SparkSession, dim: DataFrame) -> int:
    """Card fragments to the catalog of one store, in steps; the first that fails ends the run."""
    row = stores.one_store(dim, args.country or dim.first()["country"], args.store)
    made: dict[str, DataFrame] = {}
    steps = [
        ("scan", lambda: made.update(files=json_catalog.scan_files(spark, f"{args.root}/{row['dir']}/{args.fragments}"))),
        ("guard", lambda: json_catalog.require_fragments(made["files"], 1)),
        ("catalog", lambda: made.update(rows=pipeline.store_catalog(json_catalog.cards(made["files"]), args.store, ord_col="_order"))),
        ("minimum", lambda: drift.require(made["rows"].agg(F.count("*").alias("count")).filter(F.col("count") < row["minimum_products"]), "too few products")),
        ("write", lambda: sinks.json_array(made["rows"].select(*[c for c in COLUMNS if c in made["rows"].columns], F.struct(*[c for c in ("_branch", "_order") if c in made["rows"].columns]).alias("_ord")), f"{args.root}/{row['catalog_path']}", "_ord")),
    ]
    done, error = pipeline.run_steps(steps)
    print("\n".join([f"{name}: done" for name in done] + ([f"{error[0]}: {error[1]}"] if error else [])))
    return int(error is not None)


REPORTS, CHANGES = ("health", "validate", "alerts", "quality"), ("sanitize", "backfill", "overlap")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cardamom", description=__doc__)
    parser.add_argument("command", choices=(*REPORTS, *CHANGES, "prune", "run"))
    parser.add_argument("--root", required=True)
    parser.add_argument("--config", required=True)
    parser.add_argument("--baseline")
    parser.add_argument("--country")
    parser.add_argument("--store")
    parser.add_argument("--output")
    parser.add_argument("--summary", default=os.environ.get("GITHUB_STEP_SUMMARY"))
    parser.add_argument("--rejects")
    parser.add_argument("--drop", default="coop")
    parser.add_argument("--against", default="plus")
    parser.add_argument("--fragments", default="new_results/*.json")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--fail-on", choices=("error", "warning", "never"), default="error")
    parser.add_argument("--max-age-hours", type=float, default=72.0)
    parser.add_argument("--max-drop-ratio", type=float, default=0.5)
    parser.add_argument("--max-growth-ratio", type=float, default=3.0)
    args = parser.parse_args(argv)
    spark = session()
    dim = stores.select(stores.read_stores(spark, args.config), args.country, args.store)
    if args.command == "prune":
        gone = prune(spark, args.root, dim, args.dry_run)
        print("\n".join(gone) or "nothing to prune")
        return 0
    if args.command == "run":
        return run_store(args, spark, dim)
    rows, info = load(spark, args.root, dim)
    if args.command in CHANGES:
        return clean(args.command, args, spark, dim, rows)
    now = F.lit(int(time.time()))
    if args.command in ("health", "quality"):
        made = pipeline.reports(rows, dim, F.timestamp_seconds(now))
        if args.output:
            sinks.json_array(made[args.command], args.output)
        if args.command == "quality":
            print(quality.markdown(made["quality"]))
            return 0
        status = made["summary"].first()["status"]
        print(health.table(made["health"]))
        print(f"Overall: {status}")
        return health.exit_code(status, args.fail_on)
    base = json_catalog.read_baseline(spark, args.baseline)
    target = dim.select("country", "store", "minimum_products", F.col("catalog_path").alias("catalog"))
    counted = drift.against_baseline(target, info, base)
    if args.command == "validate":
        bad = drift.drop_gate(counted, max_drop=args.max_drop_ratio).filter("failure is not null").collect()
        print("\n".join(r["failure"] for r in bad) or "Store output validation passed")
        return int(bool(bad))
    seen = counted.join(info.select("country", "store", "read_error", "changed_at"), ["country", "store"], "left").withColumn("read_error", F.when(F.col("changed_at").isNull(), F.lit("catalog file is missing")).otherwise(F.col("read_error")))
    found = drift.alerts(seen, now, max_drop=args.max_drop_ratio, max_growth=args.max_growth_ratio, max_age_hours=args.max_age_hours)
    lines = drift.annotations(found).collect()
    if args.summary:
        with open(args.summary, "a", encoding="utf-8") as f:
            f.write(drift.summary(found) + "\n")
    print("\n".join(r["annotation"] for r in lines) or "Catalog monitoring passed")
    return int(bool(lines))


if __name__ == "__main__":
    raise SystemExit(main())
