"""Row-wise cleaning stages, none of which runs a job, and the two that need the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.columns import blank_to_null, millis_time, parse_text_time, strip_lower
from wareloom.operators.entity import entity_aggregate
from wareloom.operators.steps import Step, require_columns, require_unique
from wareloom.schema import BUSINESS_NAMES, NULL_TOKENS


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_like(df: DataFrame, part: str = "", kinds: tuple[type, ...] = ()) -> list[str]:
    """Names containing ``part`` whose type is one of ``kinds`` (all when empty)."""
    return [
        f.name
        for f in df.schema.fields
        if part in f.name and (not kinds or isinstance(f.dataType, kinds))
    ]


class NormalizeNames(Step):
    """Lower-case, trimmed names with underscores for spaces."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [self.normalized(c) for c in df.columns]
        require_unique(names)
        return df.toDF(*names)

    @staticmethod
    def normalized(name: str) -> str:
        return name.lower().strip().replace(" ", "_")


class RenameColumns(Step):
    """Rename by a map; a missing source or a clash is an error."""

    def _transform(self, df: DataFrame) -> DataFrame:
        mapping = self.option("mapping", BUSINESS_NAMES)
        require_columns(df, mapping)
        require_unique([mapping.get(c, c) for c in df.columns])
        return df.withColumnsRenamed(mapping)


class DropColumns(Step):
    """Drop the listed columns; ``strict`` refuses names that do not exist."""

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.option("columns", [])
        if self.option("strict", False):
            require_columns(df, columns)
        return df.drop(*columns)


class DropUnneeded(Step):
    """Drop list columns, picture and thumbnail columns and two long texts."""

    def _transform(self, df: DataFrame) -> DataFrame:
        lists = columns_like(df, kinds=(T.ArrayType,))
        marked = columns_like(df, "pic_") + columns_like(df, "thumbnail")
        return df.drop(*lists, *marked, "descriptions", "permalink")


class NullTokens(Step):
    """Texts standing for a missing value become null."""

    def _transform(self, df: DataFrame) -> DataFrame:
        tokens = self.option("tokens", NULL_TOKENS)
        return df.withColumns({c: blank_to_null(F.col(c), tokens) for c in text_columns(df)})


class TrimLower(Step):
    """Trim and lower-case every text column."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: strip_lower(F.col(c)) for c in text_columns(df)})


class ParseTimes(Step):
    """Turn columns whose name looks like a time into timestamps.

    Text is parsed by layout, whole numbers (also as text) are milliseconds since
    the epoch, other types stay as they are.
    """

    # Fixed values.
    patterns = ["time", "date"]
    clock_columns = ["start_time", "stop_time"]

    def parsed(self, df: DataFrame) -> dict[str, Column]:
        """The timestamp of each column that looks like a time."""
        patterns = self.option("patterns", self.patterns)
        parsed = {}
        for f in df.schema.fields:
            if not any(p in f.name.lower() for p in patterns):
                continue
            if isinstance(f.dataType, T.StringType):
                value = parse_text_time(F.col(f.name), f.name.lower() in self.clock_columns)
            elif isinstance(f.dataType, T.LongType):
                value = millis_time(F.col(f.name))
            else:
                continue
            parsed[f.name] = value.cast("timestamp_ntz")
        return parsed

    def _transform(self, df: DataFrame) -> DataFrame:
        parsed = self.parsed(df)
        return df.withColumns(parsed) if parsed else df


class CastNumbers(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).try_cast("double") for c in self.option("columns", [])})


class FlagsToText(Step):
    """Boolean columns as text, so they count as categories."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.option("columns") or columns_like(df, kinds=(T.BooleanType,))
        return df.withColumns({c: F.col(c).cast("string") for c in names if c in df.columns})


class DistinctRows(Step):
    """Whole-row distinct: combined inside each task first, then shuffled once."""

    batch_only = True

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.dropDuplicates()


class AggregateEntities(Step):
    """Business names, then one row per product, seller or site. Counts the rows of the keys while planning."""

    batch_only = True

    def _transform(self, df: DataFrame) -> DataFrame:
        mapping = self.option("mapping", BUSINESS_NAMES)
        if mapping:
            df = RenameColumns(mapping=mapping).transform(df)
        return entity_aggregate(
            df,
            self.option("key", "product_id"),
            nulls=self.option("nulls", "count"),
            grain=self.option("grain", "fanout"),
            keep_helpers=self.option("keep_helpers", False),
        )
