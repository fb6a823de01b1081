"""Fitted tables: a few levels travel with the stage as values, more as a table of its own."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.operators.skew import salted_join
from wareloom.sources.store import new_path

# Up to this many levels are kept as values and looked up in an expression.
INLINE = 64
# Up to this many levels of a written table are sent to every task.
SMALL = 10_000


def freeze_levels(long: DataFrame, name: str) -> dict:
    """Fitted rows of several columns: ``long`` has ``variable`` and level columns.

    Columns with few rows keep them as values, the others point to one written
    table, which a saved stage takes along.
    """
    spark = long.sparkSession
    path = new_path(spark, name)
    long.write.parquet(path)
    table = spark.read.schema(long.schema).parquet(path)
    sizes = {r.variable: r["count"] for r in table.groupBy("variable").count().collect()}
    few = [v for v, n in sizes.items() if n <= INLINE]
    names = [c for c in table.columns if c != "variable"]
    values: dict[str, list] = {v: [] for v in few}
    for row in table.where(F.col("variable").isin(few)).select("variable", *names).collect():
        values[row.variable].append([row[c] for c in names])
    return {
        "schema": table.schema.json(),
        "sizes": sizes,
        "values": values,
        "path": path if len(few) < len(sizes) else None,
    }


def few_levels(frozen: dict, column: str) -> list[list] | None:
    """Values kept for ``column``, none for a column without levels; None when they are in the written table."""
    if column in frozen["values"] or column not in frozen["sizes"]:
        return frozen["values"].get(column, [])
    return None


def is_small(frozen: dict, column: str) -> bool:
    return frozen["sizes"].get(column, 0) <= SMALL


def level_table(spark: SparkSession, frozen: dict, column: str) -> DataFrame:
    """The written rows of one column as a frame."""
    schema = T.StructType.fromJson(json.loads(frozen["schema"]))
    names = [c for c in schema.fieldNames() if c != "variable"]
    table = spark.read.schema(schema).parquet(frozen["path"])
    return table.where(F.col("variable") == column).select(*names)


def with_level(df: DataFrame, frozen: dict, column: str, text: Column, take: Column, out: str) -> DataFrame:
    """``df`` with ``out``: what ``take`` gives for the level equal to ``text``, null without one.

    The written table is sent to every task if its size at fit allows, else it is
    joined with frequent levels spread over several tasks.
    """
    table = level_table(df.sparkSession, frozen, column).withColumnRenamed("value", "_level")
    rows = df.withColumn("_level", text)
    levels = table.select("_level", take.alias(out))
    if is_small(frozen, column):
        joined = rows.join(F.broadcast(levels), "_level", "left")
    else:
        joined = salted_join(rows, levels, "_level", table, "left")
    return joined.drop("_level")
