"""How often each value of several columns occurs, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def level_counts(
    df: DataFrame, columns: list[str], by: tuple[str, ...] = (), nulls: bool = False, kind: str = "string"
) -> DataFrame:
    """(variable, *by, value, n): rows per value of each column, values cast to ``kind``.

    ``nulls`` keeps null as a value. Copies combine inside each task before the
    shuffle, so a frequent value costs one row per task.
    """
    long = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        list(by), columns, "variable", "value"
    )
    if not nulls:
        long = long.where(F.col("value").isNotNull())
    return long.groupBy("variable", *by, "value").agg(F.count("*").alias("n"))
