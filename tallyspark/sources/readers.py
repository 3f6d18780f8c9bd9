"""Readers for the supported input layouts. All take an explicit schema where one exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as text_fn


def double_schema(header: str, doubles: Sequence[str]) -> T.StructType:
    """Schema from a comma-separated header: the named columns are doubles, the rest strings."""
    names = [n.strip() for n in header.split(",")]
    return T.StructType(
        [T.StructField(n, T.DoubleType() if n in doubles else T.StringType()) for n in names]
    )


def delimited(spark: SparkSession, path, schema: T.StructType, sep: str = "::") -> DataFrame:
    """Records separated by ``sep`` (one or more characters), with surrounding blanks removed."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


def text_lines(spark: SparkSession, path, min_partitions: int | None = None) -> DataFrame:
    df = spark.read.text(path)
    return df.repartition(min_partitions) if min_partitions else df


def json_lines(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; numbers with leading zeros are accepted. Without a schema it is inferred."""
    reader = spark.read.option("allowNumericLeadingZeros", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_strings(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Rows from JSON text held in a column."""
    return df.select(F.from_json(F.col(column), schema).alias("_j")).select("_j.*")


def parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


# The columns of the season files.
SEASON_METRICS = [
    "FG", "FGA", "FG%", "3P", "3PA", "3P%", "2P", "2PA", "2P%", "eFG%", "FT",
    "FTA", "FT%", "ORB", "DRB", "TRB", "AST", "STL", "BLK", "TOV", "PF", "PTS",
]
SEASON_KEYS = ["Rk", "Player", "Pos", "Age", "Tm", "G", "GS", "MP"]


def season_csv(spark: SparkSession, path, year_pattern: str = r"_(\d{4})_") -> DataFrame:
    """Season files found by a glob, with the year taken from each file name.

    Repeated headers and blank lines are dropped, ``*`` markers removed and empty cells read as
    0. Columns: year, name, position, age, team, gp, gs, mp and the 22 metrics.
    """
    raw_schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in SEASON_KEYS + SEASON_METRICS]
    )
    raw = (
        spark.read.schema(raw_schema)
        .csv(path)
        .withColumn("year", F.regexp_extract("_metadata.file_path", year_pattern, 1).cast("int"))
    )
    rows = raw.where(F.col("Player").isNotNull() & (F.col("Rk") != "Rk"))

    def number(name: str, kind: str) -> Column:
        cell = F.trim(F.regexp_replace(F.col(f"`{name}`"), r"\*", ""))
        return F.coalesce(cell.try_cast(kind), F.lit(0).cast(kind))

    return rows.select(
        "year",
        F.trim(F.regexp_replace("Player", r"\*", "")).alias("name"),
        F.col("Pos").alias("position"),
        number("Age", "int").alias("age"),
        F.col("Tm").alias("team"),
        number("G", "int").alias("gp"),
        number("GS", "int").alias("gs"),
        number("MP", "double").alias("mp"),
        *[number(m, "double").alias(m) for m in SEASON_METRICS],
    )


def encoded_text(spark: SparkSession, path, charset: str = "GBK") -> DataFrame:
    """Lines of text in a charset other than UTF-8.

    The CSV reader splits the files and decodes them; a separator that cannot occur in text
    keeps each line in one column.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return (
        spark.read.schema("value string")
        .option("encoding", charset)
        .option("sep", "\u0001")
        .option("quote", "\u0000")
        .option("escape", "\u0000")
        .option("lineSep", "\n")
        .csv(path)
    )


def edge_list(spark: SparkSession, path, canonical: bool = False, partitions: int | None = None) -> DataFrame:
    """Whitespace-separated ``src dst`` pairs with ``#`` comments; ``attr`` is 1.

    With ``canonical`` each edge points from the smaller to the larger id.
    """
    parts = F.split(F.trim("value"), r"\s+")
    edges = (
        spark.read.text(path)
        .where(~F.col("value").startswith("#") & (F.trim("value") != ""))
        .select(
            parts[0].cast("long").alias("src"),
            parts[1].cast("long").alias("dst"),
            F.lit(1).alias("attr"),
        )
    )
    if canonical:
        edges = edges.select(
            F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "attr"
        )
    return edges.repartition(partitions) if partitions else edges


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def kafka_stream(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Unbounded (key, value) strings. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return (
        reader.option("subscribe", topics)
        .options(**options)
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"))
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = "*", fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None,
    partitions: int | None = None, fetch_size: int = 10_000, **extra: str,
) -> dict[str, str]:
    """Options for a JDBC read split over ``partitions`` ranges of ``partition_column``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def libsvm(spark: SparkSession, path, num_features: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", str(num_features)).load(path)


def image_files(spark: SparkSession, path, glob: str = "*.jpg") -> DataFrame:
    """One row per file below ``path`` with its content and the parent folder as class name."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .withColumn("class_name", text_fn.parent_folder(F.col("path")))
    )
