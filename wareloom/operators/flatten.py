"""Nested listing documents to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.operators.steps import Step, require_unique
from wareloom.schema import NAMED_PARTS, PLAIN_STRUCTS, STRUCT_LISTS, TEXT_LISTS


def join_text_lists(df: DataFrame, columns: list[str] = TEXT_LISTS) -> DataFrame:
    """Comma-joined text instead of a list of texts; null elements are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.array_join(c, ",") for c in present})


def spread_struct(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Replace a struct column by one column per field, in its place."""
    fields = df.schema[column].dataType.fieldNames()
    out = []
    for name in df.columns:
        if name == column:
            out += [F.col(f"`{column}`.`{f}`").alias(prefix + f) for f in fields]
        else:
            out.append(F.col(f"`{name}`"))
    flat = df.select(*out)
    require_unique(flat.columns)
    return flat


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """One row per element; a null or empty list keeps its row with a null."""
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    exploded = df.select(*others, F.explode_outer(column).alias(column))
    return exploded.select(*[F.col(f"`{c}`") for c in df.columns])


def explode_structs(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """Explode a list of structs and spread its (prefixed) fields.

    Naming happens in the projection above the explode, so fields nobody reads
    are pruned before rows multiply.
    """
    return spread_struct(explode_list(df, column), column, prefix)


def keep_names(df: DataFrame, columns: list[str] = NAMED_PARTS) -> DataFrame:
    """Reduce ``{id, name}`` structs to the name."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c)["name"] for c in present})


def flatten_listings(df: DataFrame) -> DataFrame:
    """All nested parts of a listing in one flat row per element combination.

    The lists are independent, so a listing yields the product of their sizes
    (empty counts as one). Sections missing from the schema are skipped.
    """
    if "id" in df.columns:
        df = df.withColumnRenamed("id", "product_id")
    df = join_text_lists(df)
    for column, prefix in STRUCT_LISTS.items():
        if column in df.columns:
            df = explode_structs(df, column, f"{prefix}_")
    for column in PLAIN_STRUCTS:
        if column in df.columns:
            df = spread_struct(df, column, f"{column}_")
    df = keep_names(df)
    if "shipping_free_methods" in df.columns:
        df = explode_structs(df, "shipping_free_methods")
        if "rule" in df.columns and isinstance(df.schema["rule"].dataType, T.StructType):
            df = spread_struct(df, "rule", "rule_")
    if "var_attribute_combinations" in df.columns:
        df = explode_structs(df, "var_attribute_combinations", "var_comb_")
    return df


class FlattenListings(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        return flatten_listings(df)
