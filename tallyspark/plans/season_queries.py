"""Season rating queries. The SQL is assembled from the metric names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import seasons as S
from ..sources.readers import SEASON_METRICS
from .registry import query

AGGS = {"count": "count", "avg": "avg", "stdev": "stddev_pop", "max": "max", "min": "min"}

SEASONS = """
counted AS (
  SELECT l_suppkey AS s, year, CAST(count(*) AS DOUBLE) AS fga,
    CAST(count(*) FILTER (l_quantity > 25) AS DOUBLE) AS fg,
    CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS tpa,
    CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity > 25) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (l_returnflag = 'A') AS DOUBLE) AS fta,
    CAST(count(*) FILTER (l_returnflag = 'A' AND l_quantity > 25) AS DOUBLE) AS ft,
    CAST(count(*) FILTER (l_discount >= 0.08) AS DOUBLE) AS orb,
    CAST(count(*) FILTER (l_discount <= 0.02) AS DOUBLE) AS drb,
    CAST(count(*) FILTER (l_tax <= 0.03) AS DOUBLE) AS ast,
    CAST(count(*) FILTER (l_tax = 0) AS DOUBLE) AS stl,
    CAST(count(*) FILTER (l_linestatus = 'O' AND l_quantity <= 5 AND year > 1996) AS DOUBLE) AS blk,
    CAST(count(*) FILTER (l_quantity < 10) AS DOUBLE) AS tov,
    CAST(count(*) FILTER (l_linenumber > 5) AS DOUBLE) AS pf
  FROM (SELECT *, greatest(year(l_shipdate), l_suppkey % 4 + 1995) AS year FROM lineitem) GROUP BY ALL),
seasons AS (
  SELECT CAST(year AS INTEGER) AS year, 'player-' || s AS name, CAST(s % 7 + 20 + year - 1995 AS INTEGER) AS age,
    fg AS "FG", fga AS "FGA", coalesce(fg / nullif(fga, 0), 0) AS "FG%", tp AS "3P", tpa AS "3PA",
    coalesce(tp / nullif(tpa, 0), 0) AS "3P%", fg - tp AS "2P", fga - tpa AS "2PA",
    coalesce((fg - tp) / nullif(fga - tpa, 0), 0) AS "2P%", coalesce((fg + tp * 0.5) / nullif(fga, 0), 0) AS "eFG%",
    ft AS "FT", fta AS "FTA", coalesce(ft / nullif(fta, 0), 0) AS "FT%", orb AS "ORB", drb AS "DRB",
    orb + drb AS "TRB", ast AS "AST", stl AS "STL", blk AS "BLK", tov AS "TOV", pf AS "PF",
    (fg - tp) * 2 + tp * 3 + ft AS "PTS"
  FROM counted)
"""


def _stats_cte(name: str, source: str, columns: list[str]) -> str:
    cols = ", ".join(f'{fn}("{c}") AS "{c}_{a}"' for c in columns for a, fn in AGGS.items())
    return f"{name} AS (SELECT year, {cols} FROM {source} GROUP BY year)"


def _z_sql(m: str) -> str:
    if m in S.WEIGHTED:
        share, attempts = S.WEIGHTED[m]
        return f'("{share}" - "{share}_avg") * "{attempts}"'
    sign = "-" if m == "TOV" else ""
    return f'{sign}(("{m}" - "{m}_avg") / nullif("{m}_stdev", 0))'


Z_NAMES = [f"z_{m}" for m in S.RATED]
BASE = _stats_cte("base", "seasons", SEASON_METRICS)
Z = (
    "z AS (SELECT seasons.*, " + ", ".join(f'{_z_sql(m)} AS "z_{m}"' for m in S.RATED)
    + " FROM seasons JOIN base USING (year))"
)
ZSTATS = _stats_cte("zstats", "z", Z_NAMES)


def _scaled_sql(m: str, which: str) -> str:
    col = f'"z_{m}"' if which == "value" else f'"z_{m}_{which}"'
    return f'(({col} - "z_{m}_avg") / nullif("z_{m}_stdev", 0))' if m in S.WEIGHTED else col


RATED_SQL = (
    "rated AS (SELECT name, z.year, age, "
    + ", ".join(f'{_scaled_sql(m, "value")} AS "z{m}"' for m in S.RATED)
    + ", "
    + ", ".join(
        f'{_scaled_sql(m, "value")} / nullif(greatest(abs({_scaled_sql(m, "max")}), abs({_scaled_sql(m, "min")})), 0) AS "n{m}"'
        for m in S.RATED
    )
    + " FROM z JOIN zstats ON z.year = zstats.year), totals AS (SELECT *, "
    + " + ".join(f'"z{m}"' for m in S.RATED) + ' AS "zTOT", '
    + " + ".join(f'"n{m}"' for m in S.RATED) + ' AS "nTOT" FROM rated)'
)
CHANGES = """
players AS (SELECT *, age - min(age) OVER (PARTITION BY name) AS exp FROM totals),
changes AS (
  SELECT name, year, age, exp, "zTOT" AS "valueZ", "nTOT" AS "valueN",
         "zTOT" - lag("zTOT") OVER w AS "deltaZ", "nTOT" - lag("nTOT") OVER w AS "deltaN"
  FROM players WINDOW w AS (PARTITION BY name ORDER BY exp, year))
"""
UP_TO_Z = f"WITH {SEASONS}, {BASE}, {Z}"
UP_TO_TOTALS = f"{UP_TO_Z}, {ZSTATS}, {RATED_SQL}"
UP_TO_CHANGES = f"{UP_TO_TOTALS}, {CHANGES}"


def _rounded_sql(columns: list[str], digits: int = 4) -> str:
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)


def _rounded(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _stat_columns(columns: list[str], mean: str = "avg") -> list[str]:
    """The columns of a statistics table that are rounded, which is all but the counts."""
    return [f"{c}_{a}" for c in columns for a in (mean, "stdev", "max", "min")]


def _stats_select(columns: list[str]) -> str:
    counts = ", ".join(f'"{c}_count"' for c in columns)
    return f"{counts}, {_rounded_sql(_stat_columns(columns))}"


@query("season_base_stats", f"WITH {SEASONS}, {BASE} SELECT year, {_stats_select(SEASON_METRICS)} FROM base")
def season_base_stats(t):
    return _rounded(S.base_stats(t.seasons), _stat_columns(SEASON_METRICS))


LONG = " UNION ALL ".join(
    f"""SELECT year, '{m}' AS metric, '{a}' AS agg, round(CAST("{m}_{a}" AS DOUBLE), 4) AS value FROM base"""
    for m in SEASON_METRICS for a in AGGS
)


@query("season_stats_long", f"WITH {SEASONS}, {BASE} {LONG}")
def season_stats_long(t):
    return S.long_stats(S.base_stats(t.seasons)).withColumn("value", F.round("value", 4))


@query(
    "season_zscores",
    f'{UP_TO_Z} SELECT name, year, {_rounded_sql(Z_NAMES)}, round({" + ".join(chr(34) + z + chr(34) for z in Z_NAMES)}, 4) AS z_total FROM z',
)
def season_zscores(t):
    z = S.z_values(t.stored_seasons()).select("name", "year", *Z_NAMES, "z_total")
    return _rounded(z, [*Z_NAMES, "z_total"])


@query("season_z_stats", f"{UP_TO_Z}, {ZSTATS} SELECT year, {_stats_select(Z_NAMES)} FROM zstats")
def season_z_stats(t):
    return _rounded(S.z_stats(S.z_values(t.stored_seasons())), _stat_columns(Z_NAMES))


N_NAMES = [f"z{m}" for m in S.RATED] + [f"n{m}" for m in S.RATED] + ["zTOT", "nTOT"]


@query("season_normalised", f"{UP_TO_TOTALS} SELECT name, year, age, {_rounded_sql(N_NAMES)} FROM totals")
def season_normalised(t):
    rated = S.normalised(t.stored_seasons()).select("name", "year", "age", *N_NAMES)
    return _rounded(rated, N_NAMES)


@query(
    "season_experience",
    f"WITH {SEASONS} SELECT name, year, age, age - min(age) OVER (PARTITION BY name) AS exp FROM seasons",
)
def season_experience(t):
    return S.experience(t.seasons.select("name", "year", "age")).orderBy("name", "exp")


@query(
    "season_deltas",
    f"{UP_TO_CHANGES} SELECT name, year, age, exp, {_rounded_sql(S.MEASURES)} FROM changes",
)
def season_deltas(t):
    return _rounded(S.deltas(S.normalised(t.stored_seasons())), S.MEASURES)


def _profile_sql(key: str, source: str) -> str:
    parts = []
    for m in S.MEASURES:
        parts.append(f'count("{m}") AS "{m}_count"')
        for a, fn in (("mean", "avg"), ("stdev", "stddev_pop"), ("max", "max"), ("min", "min")):
            parts.append(f'round({fn}("{m}"), 4) AS "{m}_{a}"')
    return f"{UP_TO_CHANGES} SELECT {key}, {', '.join(parts)} FROM {source} GROUP BY {key}"


PROFILE_COLUMNS = _stat_columns(S.MEASURES, "mean")


@query("profile_by_age", _profile_sql("age", "changes"))
def profile_by_age(t):
    changes = S.deltas(S.normalised(t.stored_seasons()))
    return _rounded(S.profile_by_age(changes), PROFILE_COLUMNS)


@query(
    "profile_by_experience",
    _profile_sql("exp", "(SELECT * FROM changes WHERE name NOT IN (SELECT name FROM changes WHERE year = 1995))"),
)
def profile_by_experience(t):
    seasons = t.stored_seasons()
    return _rounded(S.profile_by_experience(S.deltas(S.normalised(seasons)), seasons, 1995), PROFILE_COLUMNS)


MISSING = """
SELECT {key} AS event_type, count(v) AS v_count, round(avg(v), 4) AS v_avg, round(stddev_pop(v), 4) AS v_stdev,
       max(v) AS v_max, min(v) AS v_min, count(*) - count(v) AS v_missing
FROM (SELECT event_type, CASE WHEN value > 20 THEN value END AS v FROM events) GROUP BY {group}
"""


@query(
    "stats_with_missing",
    MISSING.format(key="event_type", group="event_type") + " UNION ALL " + MISSING.format(key="'(all)'", group="()"),
)
def stats_with_missing(t):
    values = t.read("events").select("event_type", F.when(F.col("value") > 20, F.col("value")).alias("v"))
    per_type = S.stats_with_missing(values, "event_type", "v")
    whole = S.stats_with_missing(values, None, "v").withColumn("event_type", F.lit("(all)"))
    return _rounded(per_type.unionByName(whole), ["v_avg", "v_stdev"])
