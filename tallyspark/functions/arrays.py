"""Array functions, all evaluated inside Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rescale(arr: Column, divisor: float = 255.0, shift: float = 0.5) -> Column:
    return F.transform(arr, lambda x: x.cast("double") / divisor - shift)


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def softmax(arr: Column) -> Column:
    """Softmax; peak and sum are bound once per row, not once per element."""
    shifted = F.transform(
        F.array(F.struct(arr.alias("a"), F.array_max(arr).cast("double").alias("peak"))),
        lambda s: F.transform(s["a"], lambda x: F.exp(x.cast("double") - s["peak"])),
    )[0]
    return F.transform(
        F.transform(F.array(shifted), lambda e: F.struct(e.alias("e"), total(e).alias("sum"))),
        lambda s: F.transform(s["e"], lambda x: x / s["sum"]),
    )[0]


def top_k(arr: Column, k: int) -> Column:
    """The ``k`` largest elements as structs (value, pos); equal values keep array order."""
    pairs = F.transform(arr, lambda x, i: F.struct(x.alias("value"), (-i).alias("neg_pos")))
    best = F.slice(F.sort_array(pairs, asc=False), 1, k)
    return F.transform(best, lambda p: F.struct(p["value"].alias("value"), (-p["neg_pos"]).alias("pos")))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
