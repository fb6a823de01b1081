"""Pairwise association of columns, all pairs in one job."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_corr(x: str, y: str) -> Column:
    """Pearson correlation over rows where both are present; null if constant."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, corr) for each pair x before y; one aggregation for all pairs."""
    pairs = list(combinations(columns, 2))
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), pair_corr(x, y).alias("corr")).alias(f"p{i}")
        for i, (x, y) in enumerate(pairs)
    ]
    return df.agg(*cells).select(F.inline(F.array(*[f"p{i}" for i in range(len(pairs))])))


def mirrored(pairs: DataFrame, measure: str, columns: list[str]) -> DataFrame:
    """Full square from the upper triangle, ones on the diagonal."""
    x, y, value = F.col("x"), F.col("y"), F.col(measure)
    last = y == columns[-1]

    def cell(a: Column, b: Column, v: Column) -> Column:
        return F.struct(a.alias("x"), b.alias("y"), v.alias(measure))

    # Each column is met once as the partner of the last one.
    one = F.lit(1.0)
    cells = F.array(
        cell(x, y, value),
        cell(y, x, value),
        F.when(last, cell(x, x, one)),
        F.when(last & (x == columns[-2]), cell(y, y, one)),
    )
    return pairs.select(F.inline(F.array_compact(cells)))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    return mirrored(corr_pairs(df, columns), "corr", columns)


def pair_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, vx, vy, n): contingency cells of all column pairs, nulls left out.

    Cells are combined inside each task, so the shuffle carries cells, not rows.
    """
    cells = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            F.col(x).cast("string").alias("vx"),
            F.col(y).cast("string").alias("vy"),
        )
        for x, y in combinations(columns, 2)
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("vx").isNotNull() & F.col("vy").isNotNull())
        .groupBy("x", "y", "vx", "vy")
        .agg(F.count("*").alias("n"))
    )


def cramers_v(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, v): bias-corrected association of each pair of categories.

    Two-by-two tables use the continuity correction. Sums over observed cells
    suffice: empty cells enter chi-squared through the margins.
    """
    cells = pair_counts(df, columns)
    rows = cells.groupBy("x", "y", "vx").agg(F.sum("n").alias("row_n"))
    cols = cells.groupBy("x", "y", "vy").agg(F.sum("n").alias("col_n"))
    row_side = rows.groupBy("x", "y").agg(
        F.sum("row_n").alias("total"), F.count("*").alias("r"), F.sum(1 / F.col("row_n")).alias("inv_rows")
    )
    col_side = cols.groupBy("x", "y").agg(
        F.count("*").alias("k"), F.sum(1 / F.col("col_n")).alias("inv_cols")
    )
    sizes = row_side.join(col_side, ["x", "y"])

    n = F.col("n").cast("double")
    product = F.col("row_n").cast("double") * F.col("col_n")
    fit = (
        cells.join(rows, ["x", "y", "vx"])
        .join(cols, ["x", "y", "vy"])
        .join(F.broadcast(sizes.select("x", "y", "total")), ["x", "y"])
        .groupBy("x", "y")
        .agg(
            F.sum(n * n / product).alias("ratio_sum"),
            F.max(F.abs(n - product / F.col("total"))).alias("gap"),
        )
    )
    total, r, k = (F.col(c).cast("double") for c in ("total", "r", "k"))
    plain = total * (F.col("ratio_sum") - 1)
    # All four gaps of a two-by-two table are equal.
    corrected = F.pow(F.greatest(F.col("gap") - 0.5, F.lit(0.0)), 2) * total * F.col("inv_rows") * F.col("inv_cols")
    chi2 = F.when((r == 2) & (k == 2), corrected).otherwise(plain)
    phi2 = F.greatest(F.lit(0.0), F.try_divide(chi2, total) - F.try_divide((k - 1) * (r - 1), total - 1))
    r_corr = r - F.try_divide(F.pow(r - 1, F.lit(2)), total - 1)
    k_corr = k - F.try_divide(F.pow(k - 1, F.lit(2)), total - 1)
    denom = F.least(k_corr - 1, r_corr - 1)
    v = F.when(denom == 0, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(phi2, denom)))
    return sizes.join(fit, ["x", "y"]).select("x", "y", v.alias("v"))


def cramers_v_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    return mirrored(cramers_v(df, columns), "v", columns)
