"""User behaviour reports over access_log(log_id, user_id, time, typed, consumed).

``typed`` is 0 for a visit and 1 for a purchase. Periods are half-open [start, end).
Every report counts per user first and joins the user's name to what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizes import top, top_per_group

VISIT, PURCHASE = 0, 1


def _at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def within(start: str, end: str, time: str = "time") -> Column:
    return (F.col(time) >= _at(start)) & (F.col(time) < _at(end))


def _named_top(per_user: DataFrame, users: DataFrame, measure: str, n: int) -> DataFrame:
    named = per_user.join(users.select("user_id", "name"), "user_id")
    return top(named, n, F.desc(measure), F.asc("user_id"))


def visits_topn(log: DataFrame, users: DataFrame, start: str, end: str, n: int = 5) -> DataFrame:
    per_user = (
        log.where(within(start, end) & (F.col("typed") == VISIT))
        .groupBy("user_id")
        .agg(F.count("log_id").alias("visits"))
    )
    return _named_top(per_user, users, "visits", n)


def spend_topn(log: DataFrame, users: DataFrame, start: str, end: str, n: int = 10, typed: int | None = None) -> DataFrame:
    """Largest total amounts, over all records or those of one type."""
    keep = within(start, end)
    if typed is not None:
        keep = keep & (F.col("typed") == typed)
    per_user = log.where(keep).groupBy("user_id").agg(F.round(F.sum("consumed"), 2).alias("spend"))
    return _named_top(per_user, users, "spend", n)


def growth_topn(
    log: DataFrame, users: DataFrame, before: tuple[str, str], after: tuple[str, str], typed: int,
    amount: Column, n: int,
) -> DataFrame:
    """Largest increase of ``amount`` from one period to the next, in a single scan."""
    later, earlier = within(*after), within(*before)
    signed = F.when(later, amount).otherwise(-amount)
    per_user = (
        log.where((later | earlier) & (F.col("typed") == typed))
        .groupBy("user_id")
        .agg(F.sum(signed).alias("_growth"))
    )
    fractions = dict(per_user.dtypes)["_growth"] == "double"
    growth = F.round("_growth", 2) if fractions else F.col("_growth")
    per_user = per_user.select("user_id", growth.alias("growth"))
    return _named_top(per_user, users, "growth", n)


def signed_union(log: DataFrame, before: tuple[str, str], after: tuple[str, str]) -> DataFrame:
    """Visit growth per user from two unioned sets of +1 and -1 rows."""
    visits = log.where(F.col("typed") == VISIT)
    plus = visits.where(within(*after)).select("log_id", "user_id", F.lit(1).alias("sign"))
    minus = visits.where(within(*before)).select("log_id", "user_id", F.lit(-1).alias("sign"))
    return plus.unionByName(minus).groupBy("user_id").agg(F.sum("sign").alias("growth"))


def first_days(
    log: DataFrame, accounts: DataFrame, registered: tuple[str, str], measure: Column, n: int = 10,
    days: int = 14, typed: int = VISIT,
) -> DataFrame:
    """Users ranked by ``measure`` over the first ``days`` days after registration.

    ``registered`` is the half-open period in which the registration must fall. Only the log
    of that period and the ``days`` after it is read, and only rows of those users are aggregated.
    Both sides come straight from their tables, so adaptive execution can split a hot user or
    broadcast a small cohort. Dates count inclusively.
    """
    cohort = accounts.where(within(*registered, time="registered"))
    window_end = F.date_add(_at(registered[1]).cast("date"), days + 1).cast("timestamp_ntz")
    recent = log.where(
        (F.col("typed") == typed) & (F.col("time") >= _at(registered[0])) & (F.col("time") < window_end)
    )
    in_time = (F.col("time") >= F.col("registered")) & (
        F.to_date("time") <= F.date_add(F.to_date("registered"), days)
    )
    per_user = (
        recent.select("user_id", "log_id", "time", "consumed").join(cohort, "user_id")
        .where(in_time)
        .groupBy("user_id", "name")
        .agg(measure.alias("amount"))
    )
    return top(per_user, n, F.desc("amount"), F.asc("user_id"))


def items_top3(log: DataFrame, device: str, n: int = 3) -> DataFrame:
    """Each user's most frequent items on devices whose name contains ``device``."""
    counts = (
        log.where(F.col("device").contains(device))
        .groupBy("user_id", "item")
        .agg(F.count("*").alias("n"))
    )
    return top_per_group(counts, ["user_id"], [F.desc("n"), F.asc("item")], n)
