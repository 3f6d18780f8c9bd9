"""Splits, exports and batch scoring for machine learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import hash_fraction
from ..session import materialise
from .sizes import top_per_group

MAX_MODEL_BYTES = 256 << 20


def numbered(df: DataFrame, order: str, name: str = "rn") -> DataFrame:
    """Rows numbered 1, 2, … in the order of a unique column.

    Rows are range-partitioned and sorted once and stored; every partition then starts at the
    number of rows before it. The table of starts has one row per partition.
    """
    bits = 33  # monotonically_increasing_id: partition above, position below
    stored = materialise(
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", bits))
    )
    sizes = stored.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_mid").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    return (
        stored.join(F.broadcast(starts), "_pid")
        .withColumn(name, (F.col("_start") + position).cast("long"))
        .drop("_mid", "_pid", "_start")
    )


def contiguous_folds(df: DataFrame, order: str, folds: int = 5) -> DataFrame:
    """Fold 1..folds in contiguous blocks of equal size; the remainder goes to the last."""
    rows = numbered(df, order, "_rn")
    size = F.floor(rows.agg(F.count("*")).scalar() / folds)
    block = F.when(size == 0, F.lit(folds)).otherwise(
        F.least(F.floor((F.col("_rn") - 1) / F.greatest(size, F.lit(1))) + 1, F.lit(folds))
    )
    return rows.withColumn("fold", block.cast("int")).drop("_rn")


def per_user_holdout(history: DataFrame, user: str, order: list[str], record: str, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Column ``part``: the name of the range holding the record's ordinal, else ``train``.

    Only the first records of each user are ranked, which Spark cuts before the shuffle; the
    marks are joined back on the unique record id, so no user's records meet in one task.
    """
    last = max(stop for _, stop in ranges.values())
    head = top_per_group(
        history.select(user, *[c for c in order if c != record], record),
        [user], [F.asc(c) for c in order], last, "_ord",
    ).select(record, "_ord")
    part = F
    for name, (start, stop) in ranges.items():
        part = part.when(F.col("_ord").between(start, stop), F.lit(name))
    return (
        history.join(head, record, "left")
        .withColumn("part", part.otherwise(F.lit("train")))
        .drop("_ord")
    )


def hash_split(df: DataFrame, key: str, validation: float = 0.2) -> DataFrame:
    """Repeatable validation flag from the hash of an integer key."""
    return df.withColumn("is_val", hash_fraction(F.col(key)) < validation)


def random_flag(df: DataFrame, validation: float = 0.2, seed: int = 7) -> DataFrame:
    return df.withColumn("is_val", F.when(F.rand(seed) > 1 - validation, F.lit(True)).otherwise(F.lit(False)))


def vector_rows(df: DataFrame, vector: str = "features", label: str = "label") -> DataFrame:
    """ML vectors as float arrays with an integer label."""
    return df.select(
        vector_to_array(vector, "float32").alias(vector), F.col(label).cast("long").alias(label)
    )


def export_shuffled(df: DataFrame, path: str, partitions: int, seed: int = 7, row_group_bytes: int = 1 << 20) -> None:
    """Parquet in random row order over ``partitions`` files, with small row groups for loaders."""
    (
        df.withColumn("_r", F.rand(seed))
        .repartitionByRange(partitions, "_r")
        .sortWithinPartitions("_r")
        .drop("_r")
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .parquet(path)
    )


def linear_model(classes: int, size: int) -> np.ndarray:
    """A fixed weight matrix (classes x size)."""
    i, j = np.arange(classes)[:, None], np.arange(size)[None, :]
    return ((i * 7 + j * 3) % 11 - 5) / 10.0


def _share(df: DataFrame, weights: np.ndarray):
    if weights.nbytes > MAX_MODEL_BYTES:
        raise ValueError(f"model of {weights.nbytes} bytes is too large to broadcast")
    return df.sparkSession.sparkContext.broadcast(weights)


def batch_score(df: DataFrame, features: str, weights: np.ndarray) -> DataFrame:
    """Adds ``scores``, one float per class. The model is read once per task."""
    shared = _share(df, weights)

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value.T
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype=object)
                continue
            yield pd.Series(list(np.stack(batch.to_numpy()).astype("float64") @ model))

    return df.withColumn("scores", score(features))


def batch_score_topk(df: DataFrame, key: str, features: str, weights: np.ndarray, k: int = 5) -> DataFrame:
    """(key, top): the ``k`` best (label, score) pairs; rows without usable features are left out."""
    shared = _share(df, weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            usable = batch[batch[features].map(lambda v: v is not None and len(v) == model.shape[1])]
            if usable.empty:
                continue
            scores = np.stack(usable[features].to_numpy()).astype("float64") @ model.T
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            top = [
                [{"label": int(c), "score": float(row[c])} for c in order]
                for row, order in zip(scores, best)
            ]
            yield pd.DataFrame({key: usable[key].to_numpy(), "top": top})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, features).mapInPandas(
        score, f"{key} {kind}, top array<struct<label:int,score:double>>"
    )


def fit_classifier(df: DataFrame, features: str, label: str, validation: float = 0.2, key: str = "vec_id") -> DataFrame:
    """Logistic regression fitted on the training part; every row gets its predicted class."""
    rows = hash_split(df, key, validation).withColumn("_x", array_to_vector(F.col(features)))
    model = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=20, regParam=0.01).fit(
        rows.where(~F.col("is_val"))
    )
    return model.transform(rows).select(key, label, "is_val", F.col("prediction").cast("int").alias("predicted"))
