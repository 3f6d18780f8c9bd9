"""Functions that SQL texts call by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name(parameters) -> returned type and body, all made of built-in functions
SQL_FUNCTIONS = {
    "compact_name(name STRING)": ("STRING", "upper(replace(name, ' ', ''))"),
    "price_band(price DOUBLE, width DOUBLE)": ("BIGINT", "CAST(floor(price / width) AS BIGINT)"),
}


def register(spark: SparkSession) -> None:
    """Makes SQL_FUNCTIONS known to the session; their bodies are inlined into the caller's plan."""
    for head, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
