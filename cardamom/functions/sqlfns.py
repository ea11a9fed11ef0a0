"""The stable functions as SQL functions of a session; Catalyst inlines their bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> list[str]:
    """Create normalize_barcode, loose_price, strict_price, collapse_ws, category_slug and whole_to_cents."""
    bodies = {
        "normalize_barcode(raw STRING) RETURNS STRING": """
            (SELECT CASE
               WHEN length(d) = 13 AND pmod(10 - aggregate(sequence(1, 12), 0, (a, i) -> a + try_cast(substring(d, i, 1) AS INT) * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END)) % 10, 10) = try_cast(right(d, 1) AS INT) THEN d
               WHEN length(d) = 8 AND pmod(10 - aggregate(sequence(1, 7), 0, (a, i) -> a + try_cast(substring(d, i, 1) AS INT) * (CASE WHEN i % 2 = 1 THEN 3 ELSE 1 END)) % 10, 10) = try_cast(right(d, 1) AS INT) THEN d
             END
             FROM (SELECT CASE WHEN length(e) = 12 THEN concat('0', e) ELSE e END AS d FROM (SELECT regexp_replace(raw, '[^0-9]', '') AS e)))""",
        "loose_price(p STRING) RETURNS DOUBLE": r"coalesce(try_cast(nullif(regexp_extract(replace(p, ',', '.'), '[0-9]+([.][0-9]+)?', 0), '') AS DOUBLE), double('Infinity'))",
        "strict_price(p STRING) RETURNS DOUBLE": r"CASE WHEN replace(trim(p), ',', '.') RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' AND try_cast(replace(trim(p), ',', '.') AS DOUBLE) > 0 AND try_cast(replace(trim(p), ',', '.') AS DOUBLE) < double('Infinity') THEN try_cast(replace(trim(p), ',', '.') AS DOUBLE) END",
        "collapse_ws(t STRING) RETURNS STRING": r"trim(regexp_replace(t, '[\\s]+', ' '))",
        "category_slug(t STRING) RETURNS STRING": "translate(lower(t), '_,', '--')",
        "whole_to_cents(p STRING) RETURNS STRING": "CASE WHEN p RLIKE '^[0-9]+$' THEN concat('0.', lpad(p, greatest(2, length(p)), '0')) ELSE p END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in bodies]
