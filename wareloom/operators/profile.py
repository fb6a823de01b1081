"""Distribution profiles of numeric columns: the numbers behind each chart."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.operators.ranks import exact_quantiles


def long_stats(counts: DataFrame, by: list[str]) -> DataFrame:
    """n, mean, sample deviation, min and max from (by, value, n) counts."""
    n, x = F.col("n").cast("double"), F.col("value")
    sums = counts.groupBy(*by).agg(
        F.sum("n").alias("total"),
        (F.sum(n * x) / F.sum(n)).alias("mean"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    )
    # Second pass around the mean: stable for large values.
    spread = (
        counts.join(F.broadcast(sums.select(*by, "mean")), by)
        .groupBy(*by)
        .agg(F.sum(n * F.pow(x - F.col("mean"), 2)).alias("squares"))
    )
    return sums.join(spread, by).withColumn(
        "std", F.when(F.col("total") > 1, F.sqrt(F.col("squares") / F.nullif(F.col("total") - 1, F.lit(0))))
    ).drop("squares")


def _stat_rows(df: DataFrame, columns: list[str], stats: dict) -> DataFrame:
    """One aggregation over all columns, then one row per column."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                *[make(F.col(c).cast("double")).alias(name) for name, make in stats.items()],
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))


def basic_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, n, mean, std, low, high)."""
    return _stat_rows(
        df,
        columns,
        {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "low": F.min, "high": F.max},
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return basic_stats(df, columns).join(F.broadcast(quartiles), "variable", "left").select(
        "variable",
        "n",
        "mean",
        "std",
        F.col("low").alias("min"),
        F.col("q_0").alias("q1"),
        F.col("q_1").alias("median"),
        F.col("q_2").alias("q3"),
        F.col("high").alias("max"),
    )


def shape_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Population skewness and excess kurtosis, nulls left out."""
    return _stat_rows(df, columns, {"skew": F.skewness, "kurtosis": F.kurtosis})


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, value) of numeric columns, nulls left out."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "variable", "value")
    return long.where(F.col("value").isNotNull())


def histogram(df: DataFrame, columns: list[str], bins: int = 25) -> DataFrame:
    """Equal-width bins over the range of each column, the last one closed.

    A constant column gets a range of one around its value.
    """
    stats = basic_stats(df, columns).where("n > 0")
    flat = F.col("high") == F.col("low")
    spans = stats.select(
        "variable",
        "mean",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("start"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")).alias("span"),
    )
    position = F.floor((F.col("value") - F.col("start")) * bins / F.col("span"))
    # One row of spans per column.
    filled = (
        long_values(df, columns)
        .join(F.broadcast(spans), "variable")
        .groupBy("variable", F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    medians = exact_quantiles(df, columns, [0.5])
    frame = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = F.col("span") / bins
    return (
        frame.join(filled, ["variable", "bin"], "left")
        .join(F.broadcast(medians), "variable")
        .select(
            "variable",
            "bin",
            (F.col("start") + F.col("bin") * width).alias("bin_start"),
            (F.col("start") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
            "mean",
            F.col("q_0").alias("median"),
        )
    )


@F.pandas_udf(T.DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    """Spark has no error function; called on grid points only."""
    return z.map(lambda v: 0.5 * (1.0 + math.erf(v / math.sqrt(2.0))))


def normal_reference(df: DataFrame, columns: list[str], points: int = 50) -> DataFrame:
    """Normal density and distribution with each column's moments, on a grid."""
    grid = basic_stats(df, columns).where("std > 0").select(
        "variable",
        "mean",
        "std",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
        (F.col("high") - F.col("low")).alias("span"),
        "low",
    )
    x = F.col("low") + F.col("span") * F.col("point") / (points - 1)
    z = (F.col("x") - F.col("mean")) / F.col("std")
    return (
        grid.withColumn("x", x)
        .withColumn("z", z)
        .select(
            "variable",
            "point",
            "x",
            (F.exp(-F.col("z") * F.col("z") / 2) / (F.col("std") * math.sqrt(2 * math.pi))).alias("pdf"),
            normal_cdf("z").alias("cdf"),
        )
    )


def density(counts: DataFrame, by: list[str], points: int = 200, cut: float = 3.0, bins: int = 2048) -> DataFrame:
    """Gaussian kernel density on a grid from (by, value, n) counts.

    Scott bandwidth, grid reaching ``cut`` bandwidths past the data. Values are
    first counted in ``bins`` equal bins of their range and stand at the middle of
    their bin, so only bins meet the grid points, whatever the number of values.
    """
    stats = long_stats(counts, by).where("std > 0").withColumn(
        "width", F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    )
    spans = stats.select(
        *by,
        "total",
        "width",
        "low",
        ((F.col("high") - F.col("low")) / bins).alias("bin_width"),
        (F.col("low") - cut * F.col("width")).alias("start"),
        ((F.col("high") - F.col("low") + 2 * cut * F.col("width")) / (points - 1)).alias("step"),
    )
    bin_ = F.least(F.floor((F.col("value") - F.col("low")) / F.col("bin_width")), F.lit(bins - 1))
    binned = counts.join(F.broadcast(spans), by).groupBy(*by, bin_.alias("bin")).agg(F.sum("n").alias("n"))
    reached = binned.join(F.broadcast(spans), by).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    x = F.col("start") + F.col("point") * F.col("step")
    middle = F.col("low") + (F.col("bin") + 0.5) * F.col("bin_width")
    z = (x - middle) / F.col("width")
    kernel = F.col("n") * F.exp(-z * z / 2)
    sums = reached.groupBy(*by, "point").agg(F.sum(kernel).alias("mass"))
    norm = F.col("total") * F.col("width") * math.sqrt(2 * math.pi)
    return sums.join(F.broadcast(spans), by).select(
        *by, "point", x.alias("x"), (F.col("mass") / norm).alias("density")
    )


def box_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and the outliers beyond."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "variable", F.col("q_0").alias("q1"), F.col("q_1").alias("median"), F.col("q_2").alias("q3")
    )
    fences = quartiles.withColumns(
        {
            "fence_low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "fence_high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    x = F.col("value")
    inside = (x >= F.col("fence_low")) & (x <= F.col("fence_high"))
    return (
        long_values(df, columns)
        .join(F.broadcast(fences), "variable")
        .groupBy("variable", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
