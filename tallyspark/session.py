"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Skewed sort-merge joins are split even when that
# costs one more exchange, because a single key may hold a large share of the rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which the driver and all executors share.

    Where that is unset, a folder in the warehouse, if the warehouse is no local path or all runs on one machine;
    else there is no folder to share, and the setting is asked for.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    if (warehouse.startswith(("file:", "/"))) and not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse.rstrip('/')}/_stages"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and return that table.

    This cuts the lineage, survives the loss of executors, and lets Spark choose the next join
    by the size of the stored files. A loop passes its previous table as ``instead_of``, which
    is removed once the new one is complete.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    if instead_of is not None:
        remove(spark, instead_of.stored_at)
    return stored


def _file_system(spark: SparkSession, path: str):
    known = getattr(spark.sparkContext, "_tallyspark_hadoop", None)
    if known is None:  # looked up once: every name on the way is a call to the JVM
        known = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.commons.lang3.ArrayUtils
        spark.sparkContext._tallyspark_hadoop = known
    target = known[0](path)
    return target.getFileSystem(known[1]), target


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def folders_below(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths relative to ``path`` that match ``pattern`` (such as ``day=*/batch=*``), in one call. No part of the
    pattern may match a slash or a comma."""
    fs, target = _file_system(spark, f"{path}/{pattern}")
    found = fs.globStatus(target)
    if not found:
        return []
    depth = pattern.count("/") + 1
    text = spark.sparkContext._tallyspark_hadoop[2].toString(spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found))
    return sorted("/".join(p.split("/")[-depth:]) for p in text[1:-1].split(","))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, without hidden ones."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(target) if f.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder in one step; nothing may be at ``target``."""
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise RuntimeError(f"cannot move {source} to {target}")
