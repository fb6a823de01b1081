"""Sources and sinks of listing data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.schema import LISTING_SCHEMA


def read_listings(spark: SparkSession, path: str, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """JSON Lines, one document per line; a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_listings(lines: DataFrame, column: str, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """Same documents already held as text in a column."""
    parsed = F.from_json(F.col(column), schema, {"mode": "FAILFAST"})
    return lines.select(parsed.alias("doc")).select("doc.*")


def as_frame(
    spark: SparkSession,
    source: DataFrame | str | Iterable[dict],
    schema: T.StructType = LISTING_SCHEMA,
) -> DataFrame:
    """Accept a frame, a path or a handful of literal records."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str):
        return read_listings(spark, source, schema)
    names = schema.fieldNames()
    rows = [tuple(record.get(name) for name in names) for record in source]
    return spark.createDataFrame(rows, schema)


def write_listings(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


#: Packed files cannot be split: about 130 MB of listings each, so that many tasks read them.
LINES_PER_FILE = 100_000


def write_lines(lines: DataFrame, path: str) -> str:
    """Documents already held as text in the only column, packed: their names take more room than their values."""
    lines.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
