"""Fitted row-wise stages on a stream of listing documents.

Fitted decisions are frozen, so the same stages run unchanged on a stream.
Whole-table stages (distinct rows, entity aggregation) are refused: their
result would change with every batch.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wareloom.schema import LISTING_SCHEMA


def read_listing_stream(spark: SparkSession, path: str, schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)


def row_stages(model: PipelineModel) -> list[Transformer]:
    """The stages of a fitted pipeline that need no other row."""
    return [stage for stage in model.stages if not getattr(stage, "batch_only", False)]


def apply_stages(stream: DataFrame, stages: list[Transformer]) -> DataFrame:
    for stage in stages:
        if getattr(stage, "batch_only", False):
            raise ValueError(f"{type(stage).__name__} needs the whole table")
        stream = stage.transform(stream)
    return stream
