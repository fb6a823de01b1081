"""Counts, shares, distinct values, duplicates, samples and calendar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.functions.columns import hash_text, weekday_label, weekday_name
from wareloom.operators.decide import null_ratio
from wareloom.operators.levels import level_counts
from wareloom.operators.skew import salted_join
from wareloom.schema import TIME_COLUMNS, WEEKDAY_LABELS, WEEKDAYS


def n_distinct(column: str):
    """Distinct values with null as one of them."""
    return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))


def conflicting_keys(df: DataFrame, key: str, column: str, out: str = "n_values") -> DataFrame:
    """Keys that carry more than one value of ``column``."""
    return df.groupBy(key).agg(n_distinct(column).alias(out)).where(F.col(out) > 1)


def varying_keys(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per key the number of values of each column, where any varies.

    One pass over (key, column, value) instead of one distinct per column.
    """
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    distinct = (
        df.select(key, F.posexplode(cells).alias("slot", "value"))
        .groupBy(key, "slot", "value")
        .agg(F.lit(1).alias("one"))
    )
    wide = distinct.groupBy(key).agg(
        *[F.count(F.when(F.col("slot") == i, 1)).alias(f"n_{c}") for i, c in enumerate(columns)]
    )
    return wide.where(F.greatest(*[F.col(f"n_{c}") for c in columns], F.lit(0)) > 1)


def count_rows(df: DataFrame, keys: list[str], out: str = "n", ordered: bool = True) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias(out))
    return counts.orderBy(F.col(out).desc(), *keys) if ordered else counts


def repeated_rows(df: DataFrame, out: str = "n") -> DataFrame:
    """Groups of fully identical rows, with their size."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def rows_with_repeated_key(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once, all copies kept.

    A window per key would hold all copies of a hot key in one task; the key
    counts are joined back with hot keys salted instead.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return salted_join(df, counts.where("n > 1").select(key), key, counts, "left_semi")


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows per value; ``normalize`` adds the share among non-null values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def cross_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows per pair of values, pairs with a null left out."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.where(both).groupBy(x, y).agg(F.count("*").alias("n"))


def category_shares(df: DataFrame, columns: list[str], rare_below: float = 0.05) -> DataFrame:
    """(variable, value, n, share, rare) of categorical columns in one pass."""
    counts = level_counts(df, columns)
    totals = counts.groupBy("variable").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    return counts.join(F.broadcast(totals), "variable").select(
        "variable", "value", "n", share.alias("share"), (share < rare_below).alias("rare")
    )


def category_target_counts(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    return level_counts(df, columns, (target,))


def missing_report(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """(variable, ratio) of nulls, largest first."""
    wide = df.agg(*[null_ratio(c).alias(c) for c in df.columns])
    report = wide.unpivot([], df.columns, "variable", "ratio")
    if only_missing:
        report = report.where("ratio > 0").withColumn("above_third", F.col("ratio") > 1 / 3)
    return report.orderBy(F.col("ratio").desc(), "variable")


def grouped_stats(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(variable, group, mean, std, n, n_unique), one row per column and group."""
    aggs = []
    for c in columns:
        value = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.count(c).alias("n"),
            ).alias(c)
        )
    wide = df.groupBy(group).agg(*aggs)
    stats = wide.select(group, F.inline(F.array(*columns)))
    distinct = (
        level_counts(df, columns, (group,), kind="double").groupBy("variable", group).agg(F.count("*").alias("n_unique"))
    )
    return stats.join(distinct, ["variable", group], "left").withColumn(
        "n_unique", F.coalesce("n_unique", F.lit(0))
    )


def top_rows(df: DataFrame, by: str, tie: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_first(), tie).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` random rows, the same for any partitioning of the table."""
    return df.orderBy(hash_text(F.col(key), seed), key).limit(n)


def first_row(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(1)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def schema_rows(df: DataFrame) -> DataFrame:
    """(position, name, type) of a frame; spread from its own (empty) projection."""
    fields = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(F.array(*fields)), "n_rows")


def weekday_frame(spark: SparkSession) -> DataFrame:
    """The seven days in order, with their label."""
    rows = [(i, day, WEEKDAY_LABELS[day]) for i, day in enumerate(WEEKDAYS)]
    return spark.createDataFrame(rows, "position int, weekday string, label string")


def long_times(df: DataFrame, columns: list[str] = TIME_COLUMNS) -> DataFrame:
    return df.select(*columns).unpivot([], columns, "time_column", "moment")


def all_weekdays(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every time column with every day: seven rows per column name."""
    names = F.array(*[F.lit(c) for c in columns])
    return weekday_frame(df.sparkSession).select(F.explode(names).alias("time_column"), "position", "weekday", "label")


def weekday_counts(df: DataFrame, columns: list[str] = TIME_COLUMNS) -> DataFrame:
    """Rows per weekday label of each time column, absent days as zero."""
    counts = (
        long_times(df, columns)
        .groupBy("time_column", weekday_label(F.col("moment")).alias("label"))
        .agg(F.count("moment").alias("n"))
    )
    days = all_weekdays(df, columns)
    return (
        days.join(counts, ["time_column", "label"], "left")
        .select("time_column", "label", "position", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("time_column", "position")
    )


def weekday_hours(df: DataFrame, columns: list[str] = TIME_COLUMNS) -> DataFrame:
    """Weekday by hour counts of each time column.

    Hours without rows are zero; a weekday without any row is null throughout.
    """
    hours = list(range(24))
    counts = (
        long_times(df, columns)
        .where(F.col("moment").isNotNull())
        .select("time_column", weekday_name(F.col("moment")).alias("weekday"), F.hour("moment").alias("hour"))
        .groupBy("time_column", "weekday")
        .pivot("hour", hours)
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )
    named = counts.select("time_column", "weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    days = all_weekdays(df, columns).drop("label")
    return days.join(named, ["time_column", "weekday"], "left").orderBy("time_column", "position")
