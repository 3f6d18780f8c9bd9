"""State of one's own per key: what a streaming aggregation cannot hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CROSSING_KEYS = ["day", "user_id", "ad_id"]
STATE = "counts binary"
#: Groups of keys in a day. A group is one call of Python and one row of state.
GROUPS = 256
NO_TIME = np.iinfo(np.int64).max
#: Columns of the rows a group works on: the key, which of its parts are null, a time, and the clicks the row stands for.
USER, AD, NULLS, AT, N = range(5)


def counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``rows`` by key and time; the clicks of the key up to each row; whether the row is the last of its key."""
    rows = rows[np.lexsort((rows[:, AT], rows[:, NULLS], rows[:, AD], rows[:, USER]))]
    new = np.r_[True, (rows[1:, :AT] != rows[:-1, :AT]).any(1)]
    total = np.cumsum(rows[:, N])
    starts = np.flatnonzero(new)
    before = np.repeat(total[starts] - rows[starts, N], np.diff(np.r_[starts, len(rows)]))
    return rows, total - before, np.r_[new[1:], True]


def threshold_crossings(clicks: DataFrame, threshold: int, watermark: str, keep: str = "1 day", groups: int = GROUPS) -> DataFrame:
    """(day, user_id, ad_id, at, n) once per key, when its clicks of the day first exceed ``threshold``.

    ``clicks`` is a stream whose input comes in the order of time, from batch to batch; within a batch the
    clicks are ordered here. An aggregation would give the count after every batch; which click crossed the
    threshold, and that it was told already, is state of one's own: the count per key, up to one above the threshold. It is
    dropped once the watermark has passed the day's end by ``keep``.

    Most keys have a click or two, so a call per key would cost far more than the clicks. The keys of a day are dealt
    into ``groups`` by their hash, and a call sees those of one, as arrays; its state is their counts. Of a
    key's clicks in a batch no more than cross the threshold are held.
    """
    flags = F.col("user_id").isNull().cast("long") + F.col("ad_id").isNull().cast("long") * 2
    timed = clicks.withWatermark("ts", watermark).select(
        "day", "ts", F.pmod(F.xxhash64("user_id", "ad_id"), F.lit(groups)).cast("int").alias("part"),
        F.coalesce("user_id", F.lit(0)).alias("user_id"), F.coalesce("ad_id", F.lit(0)).alias("ad_id"), flags.alias("nulls"),
        F.coalesce(F.unix_micros("ts"), F.lit(int(NO_TIME))).alias("us"),
        F.coalesce(F.unix_millis(F.date_add("day", 1).cast("timestamp") + F.expr(f"interval {keep}")), F.lit(0)).alias("expires"),
    )

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = np.frombuffer(state.get[0], "<i8").reshape(-1, 4) if state.exists else np.zeros((0, 4), np.int64)
        # counts of earlier batches come before all clicks of their key
        held = np.insert(known, AT, np.iinfo(np.int64).min, axis=1)
        expires = 0
        for frame in frames:
            expires = max(expires, int(frame["expires"].max()))
            own = frame[["user_id", "ad_id", "nulls", "us"]].to_numpy(np.int64)
            held, upto, last = counted(np.vstack([held, np.insert(own, N, 1, axis=1)]))
            some = upto <= threshold + 1
            held, upto, last = held[some], upto[some], np.r_[(held[some][1:, :AT] != held[some][:-1, :AT]).any(1), True]
        crossed = held[(upto == threshold + 1) & (held[:, AT] > np.iinfo(np.int64).min)]
        if len(crossed):
            yield pd.DataFrame({
                "day": key[0],
                "user_id": pd.Series(crossed[:, USER]).astype("Int64").mask((crossed[:, NULLS] & 1) > 0),
                "ad_id": pd.Series(crossed[:, AD]).astype("Int64").mask((crossed[:, NULLS] & 2) > 0),
                "at": pd.to_datetime(pd.Series(crossed[:, AT]).where(crossed[:, AT] != NO_TIME), unit="us"),
                "n": threshold + 1,
            })
        counts = np.column_stack([held[last][:, :AT], upto[last]])
        state.update((counts.astype("<i8").tobytes(),))
        state.setTimeoutTimestamp(max(expires, state.getCurrentWatermarkMs() + 1))

    return timed.groupBy("day", "part").applyInPandasWithState(
        step, "day date, user_id bigint, ad_id bigint, at timestamp, n bigint", STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def state_rows(spark, checkpoint: str) -> DataFrame:
    """(key, value) of the state that a stopped stream left at ``checkpoint``."""
    return spark.read.format("statestore").load(checkpoint).select("key", "value")
