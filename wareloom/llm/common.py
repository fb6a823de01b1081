"""Expressions and small helpers that the text operators share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wareloom.sources.store import materialize, new_path

__all__ = [
    "SPACE",
    "WORD",
    "free_names",
    "importable",
    "let",
    "lower_ascii",
    "materialize",
    "new_path",
    "placed",
    "read_table",
    "words",
]

# Runs of the six ASCII white-space characters, and what is a word between them.
BLANKS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers find this package where it is not installed but lies at the same place."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        env["PYTHONPATH"] = ":".join([*known, root])
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also when a lambda inside uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted helper column names, each made unlike every column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def placed(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with a gapless place from 0 along ``order`` inside each ``by``, dealt out once.

    Every row keeps its position in its range of a written table, so a place is
    the position less the first of its group there, plus the group's rows in the
    ranges before. ``by`` names a bounded set (shards, languages): the offsets
    are one row per range and group in it, at most ranges plus groups, and go to
    every task. ``rows`` is read twice, once to choose the ranges.
    """
    part, at, first, before = free_names(rows, "_part", "_at", "_first", "_before")
    ranged = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    ranged = ranged.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()})
    ranged = materialize(ranged, "places")
    sums = ranged.groupBy(*by, part).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, part, first, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    place = (F.col(at) - F.col(first) + F.col(before)).cast("long")
    joined = ranged.join(F.broadcast(offsets), [*by, part])
    return joined.select(*[c for c in rows.columns if c != name], place.alias(name))
