"""Named queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
