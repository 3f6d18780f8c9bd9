"""Writers and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_dir(df: DataFrame, path: str, sep: str = "\t", files: int | None = None) -> None:
    """All columns as text joined by ``sep``. ``files`` bounds the number of output files."""
    line = F.concat_ws(sep, *[F.col(f"`{c}`").cast("string") for c in df.columns])
    out = df.select(line.alias("value"))
    (out.coalesce(files) if files else out).write.mode("overwrite").text(path)


def parquet_dir(
    df: DataFrame, path: str, partitions: int | None = None, row_group_bytes: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    out = df.repartition(partitions) if partitions else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def json_dir(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def managed_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def jdbc_options(url: str, table: str, batch_size: int = 1_000, connections: int = 16, **extra: str) -> dict[str, str]:
    return {
        "url": url, "dbtable": table, "batchsize": str(batch_size),
        "numPartitions": str(connections), **extra,
    }


def jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """Batched inserts over at most ``connections`` database connections."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **kwargs)).mode(mode).save()


def views(temp: dict[str, DataFrame] | None = None, global_temp: dict[str, DataFrame] | None = None) -> None:
    for name, df in (temp or {}).items():
        df.createOrReplaceTempView(name)
    for name, df in (global_temp or {}).items():
        df.createOrReplaceGlobalTempView(name)
