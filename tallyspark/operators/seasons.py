"""Season ratings: yearly statistics, z-scores, normalised values, deltas and profiles.

A season table has one row per (name, year) with name, year, age and the 22 metrics of
``sources.readers.SEASON_METRICS``. It is read in several passes, so pass a stored table.
Missing values are NULL and stay out of every statistic; a year in which a metric does not
vary has no z-score for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import column_stats, max_abs_scaled, missing, z_score
from ..sources.readers import SEASON_METRICS

# The nine rated metrics in the order of their totals.
RATED = ["FG", "FT", "3P", "TRB", "AST", "STL", "BLK", "TOV", "PTS"]
WEIGHTED = {"FG": ("FG%", "FGA"), "FT": ("FT%", "FTA")}
MEASURES = ["valueZ", "valueN", "deltaZ", "deltaN"]


def yearly_stats(seasons: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per year with five aggregates of each column, in one aggregation."""
    return seasons.groupBy("year").agg(*[a for c in columns for a in column_stats(F.col(c), c)])


def base_stats(seasons: DataFrame) -> DataFrame:
    return yearly_stats(seasons, SEASON_METRICS)


def long_stats(stats: DataFrame) -> DataFrame:
    """(year, metric, agg, value) from the wide yearly statistics."""
    names = [c for c in stats.columns if c != "year"]
    wide = stats.select("year", *[F.col(c).cast("double").alias(c) for c in names])
    tall = wide.unpivot("year", names, "_key", "value")
    return tall.select(
        "year",
        F.regexp_extract("_key", r"^(.*)_[^_]+$", 1).alias("metric"),
        F.regexp_extract("_key", r"_([^_]+)$", 1).alias("agg"),
        "value",
    )


def _raw_value(metric: str) -> Column:
    """Plain z-score, or distance from the mean times the attempts for the percentages."""
    if metric in WEIGHTED:
        share, attempts = WEIGHTED[metric]
        return (F.col(share) - F.col(f"{share}_avg")) * F.col(attempts)
    z = z_score(F.col(metric), F.col(f"{metric}_avg"), F.col(f"{metric}_stdev"))
    return -z if metric == "TOV" else z


def _sum(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def z_values(seasons: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Seasons with the nine values ``z_*`` and their total.

    The statistics have one row per year, so they are broadcast and the seasons do not move.
    """
    stats = base_stats(seasons) if stats is None else stats
    needed = ["FG%", "FT%", *[m for m in RATED if m not in WEIGHTED]]
    lookup = stats.select("year", *[f"{m}_{a}" for m in needed for a in ("avg", "stdev")])
    joined = seasons.join(F.broadcast(lookup), "year")
    scored = joined.select(
        *[seasons[c] if c != "year" else F.col("year") for c in seasons.columns],
        *[_raw_value(m).alias(f"z_{m}") for m in RATED],
    )
    return scored.withColumn("z_total", _sum([F.col(f"z_{m}") for m in RATED]))


def z_stats(z: DataFrame) -> DataFrame:
    return yearly_stats(z, [f"z_{m}" for m in RATED])


def normalised(seasons: DataFrame) -> DataFrame:
    """Seasons with zFG … zPTS, zTOT and nFG … nPTS, nTOT."""
    z = z_values(seasons)
    stats = z_stats(z)
    lookup = stats.select("year", *[f"z_{m}_{a}" for m in RATED for a in ("avg", "stdev", "max", "min")])
    joined = z.join(F.broadcast(lookup), "year")

    def scaled(metric: str, which: str) -> Column:
        value = F.col(f"z_{metric}" if which == "value" else f"z_{metric}_{which}")
        if metric in WEIGHTED:
            return z_score(value, F.col(f"z_{metric}_avg"), F.col(f"z_{metric}_stdev"))
        return value

    kept = [F.col(c) for c in seasons.columns]
    out = joined.select(
        *kept,
        *[scaled(m, "value").alias(f"z{m}") for m in RATED],
        *[
            max_abs_scaled(scaled(m, "value"), scaled(m, "max"), scaled(m, "min")).alias(f"n{m}")
            for m in RATED
        ],
    )
    return out.withColumns(
        {
            "zTOT": _sum([F.col(f"z{m}") for m in RATED]),
            "nTOT": _sum([F.col(f"n{m}") for m in RATED]),
        }
    )


def experience(players: DataFrame) -> DataFrame:
    """Adds ``exp``, the years since the player's youngest season.

    A player has at most one row per year, so the groups of this window stay small.
    """
    first = F.min("age").over(Window.partitionBy("name"))
    return players.withColumn("exp", F.col("age") - first)


def deltas(players: DataFrame) -> DataFrame:
    """(name, year, age, exp, valueZ, valueN, deltaZ, deltaN) with change since the last season."""
    w = Window.partitionBy("name").orderBy("exp", "year")
    return experience(players).select(
        "name",
        "year",
        "age",
        "exp",
        F.col("zTOT").alias("valueZ"),
        F.col("nTOT").alias("valueN"),
        (F.col("zTOT") - F.lag("zTOT").over(w)).alias("deltaZ"),
        (F.col("nTOT") - F.lag("nTOT").over(w)).alias("deltaN"),
    )


def profile(changes: DataFrame, key: str) -> DataFrame:
    return changes.groupBy(key).agg(
        *[a for m in MEASURES for a in column_stats(F.col(m), m, mean_name="mean")]
    )


def profile_by_age(changes: DataFrame) -> DataFrame:
    return profile(changes, "age")


def profile_by_experience(changes: DataFrame, seasons: DataFrame, partial_year: int) -> DataFrame:
    """Profile by experience without the players who were active in the partial first year.

    Their names come from the seasons, which needs no statistics."""
    known_before = seasons.where(F.col("year") == partial_year).select("name").distinct()
    return profile(changes.join(known_before, "name", "left_anti"), "exp")


def stats_with_missing(df: DataFrame, key: str | None, value: str) -> DataFrame:
    """Five aggregates and the number of missing values, per key or over all rows."""
    grouped = df.groupBy(key) if key else df.groupBy()
    return grouped.agg(*column_stats(F.col(value), value), missing(F.col(value)).alias(f"{value}_missing"))


