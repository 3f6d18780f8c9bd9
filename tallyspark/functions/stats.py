"""Statistics over columns in which NULL stands for a missing measurement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def column_stats(value: Column, prefix: str, mean_name: str = "avg") -> list[Column]:
    """Count, mean, population deviation, maximum and minimum of the present values."""
    return [
        F.count(value).alias(f"{prefix}_count"),
        F.avg(value).alias(f"{prefix}_{mean_name}"),
        F.stddev_pop(value).alias(f"{prefix}_stdev"),
        F.max(value).alias(f"{prefix}_max"),
        F.min(value).alias(f"{prefix}_min"),
    ]


def missing(value: Column) -> Column:
    return F.count("*") - F.count(value)


def z_score(value: Column, mean: Column, stdev: Column) -> Column:
    return F.try_divide(value - mean, stdev)


def max_abs_scaled(value: Column, high: Column, low: Column) -> Column:
    return F.try_divide(value, F.greatest(F.abs(high), F.abs(low)))


def hash_fraction(key: Column) -> Column:
    """A repeatable number in [0, 1) from an integer key (multiplicative hashing)."""
    return F.pmod(F.pmod(key, F.lit(2147483647)) * 2654435761, F.lit(4294967296)) / F.lit(4294967296.0)
