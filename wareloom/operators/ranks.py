"""Running totals, ranks and exact quantiles without a single-task window.

Quantiles are found by counting alone: value ranges are refined until the wanted
value is left. Running totals need the order.

A global window puts the whole table into one task. Here the rows are range
partitioned by the requested order and written once, so that every row keeps
the number of its range; each range then only needs the total of the ranges
before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareloom.operators.levels import level_counts
from wareloom.sources.store import materialize


# Bins per refinement of a value range, and the accuracy of the sketch that gives the first range.
BINS = 1024
SKETCH = 10_000


def running_totals(
    df: DataFrame,
    by: list[str],
    order: list[str | Column],
    totals: dict[str, str],
) -> DataFrame:
    """Inclusive running sum of ``totals[out]`` along ``order`` inside each ``by``.

    ``order`` must be distinct inside each ``by`` (aggregate first), so a value
    shared by many rows is one row here and cannot overload a range. ``by``
    names a bounded set such as variables, levels or classes.
    """
    ranged = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")

    # One row per range and group met in it: at most ranges + groups rows.
    sums = ranged.groupBy(*by, "_range").agg(
        *[F.sum(source).alias(f"_sum_{out}") for out, source in totals.items()]
    )
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_off_{out}") for out in totals],
    )

    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(offsets), [*by, "_range"])
    return joined.withColumns(
        {out: F.col(f"_off_{out}") + F.sum(source).over(inside) for out, source in totals.items()}
    ).drop("_range", *[f"_off_{out}" for out in totals])


def value_counts_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, value, n) of numeric columns, nulls left out, one pass."""
    return level_counts(df, columns, kind="double")


def ranked_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, value, n, cum) of numeric columns, read from one written table."""
    return running_totals(value_counts_long(df, columns), ["variable"], ["value"], {"cum": "n"})


def with_totals(ranked: DataFrame) -> DataFrame:
    sizes = ranked.groupBy("variable").agg(F.max("cum").alias("total"))
    return ranked.join(F.broadcast(sizes), "variable")


def empirical_cdf(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, value, n, cum, share) over the distinct values of each column."""
    return with_totals(ranked_values(df, columns)).select(
        "variable", "value", "n", "cum", (F.col("cum") / F.col("total")).alias("share")
    )


def _bins_of(df: DataFrame, ranges: list[tuple[str, float, float]]) -> dict[int, list]:
    """Per range the filled bins (rows, smallest, largest value), in order; one aggregation for all ranges."""
    cells = []
    for i, (c, low, high) in enumerate(ranges):
        x = F.col(c).cast("double")
        # In halves where the width of a range exceeds the largest double.
        half = 0.5 if math.isinf(high - low) else 1.0
        place = F.floor((x * half - F.lit(low * half)) / F.lit(high * half - low * half) * BINS)
        inside = (x >= F.lit(low)) & (x <= F.lit(high))
        bin_ = F.least(place, F.lit(BINS - 1)).cast("int")
        cells.append(F.when(inside, F.struct(F.lit(i).alias("part"), bin_.alias("bin"), x.alias("x"))))
    counts = (
        df.select(F.inline(F.array_compact(F.array(*cells))))
        .groupBy("part", "bin")
        .agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    bins: dict[int, list] = {i: [] for i in range(len(ranges))}
    # At most BINS rows per range.
    for r in sorted(counts.collect(), key=lambda r: (r.part, r.bin)):
        bins[r.part].append((r.n, r.low, r.high))
    return bins


def _finite(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def _starts(df: DataFrame, columns: list[str], shares: list[float]) -> dict:
    """Per column how many values are -inf, finite, inf and anything, the finite range, and sketched values around each share."""
    around = [min(max(share + side / SKETCH, 0.0), 1.0) for share in shares for side in (-2, 2)]
    cells = []
    for c in columns:
        v, finite = F.col(c).cast("double"), _finite(c)
        sketched = F.percentile_approx(finite, around, SKETCH) if around else F.lit(None).cast("array<double>")
        cells.append(
            F.struct(
                F.count(v).alias("size"),
                F.count_if(v == -float("inf")).alias("below"),
                F.count(finite).alias("n"),
                F.count_if((v == float("inf")) & ~F.isnan(v)).alias("above"),
                F.min(finite).alias("low"),
                F.max(finite).alias("high"),
                sketched.alias("sketched"),
            ).alias(c)
        )
    return df.agg(*cells).first().asDict() if cells else {}


def _rows_before(df: DataFrame, ranges: list[tuple[str, float, float]]) -> list[tuple[int, int]]:
    """Per range the finite values below it and those in it."""
    cells = []
    for i, (c, low, high) in enumerate(ranges):
        v = _finite(c)
        cells += [F.count_if(v < low).alias(f"below_{i}"), F.count_if((v >= low) & (v <= high)).alias(f"inside_{i}")]
    row = df.agg(*cells).first()
    return [(row[f"below_{i}"], row[f"inside_{i}"]) for i in range(len(ranges))]


def order_statistics(
    df: DataFrame, wanted: dict[str, set[int]], starts: dict | None = None, shares: list[float] = ()
) -> dict[tuple[str, int], float]:
    """The k-th smallest value (from 0) of columns, for each wanted k, without sorting or writing.

    Each pass counts the rows of the range that still holds the value in 1024
    bins, and the next range is what the bin with the value spans. The first
    range comes from a sketch, where ``starts`` have one: it is used only if
    counting shows that the value lies in it, else the search starts from all
    values. Infinities and NaN, the largest, are counted apart.
    """
    starts = starts or _starts(df, list(wanted), [])
    infinite = float("inf")
    found: dict[tuple[str, int], float] = {}
    # (column, low, high) -> [(k, k counted from the start of the range)]
    state: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
    guesses: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
    for c, ks in wanted.items():
        s = starts[c]
        for k in ks:
            if k < s.below:
                found[c, k] = -infinite
            elif k < s.below + s.n:
                at = k - s.below
                near = _sketched_range(s, at, shares)
                into = state if near is None else guesses
                into.setdefault((c, *(near or (s.low, s.high))), []).append((k, at))
            else:
                found[c, k] = infinite if k < s.below + s.n + s.above else float("nan")
    if guesses:
        ranges = list(guesses)
        for (c, low, high), (below, inside) in zip(ranges, _rows_before(df, ranges)):
            for k, at in guesses[c, low, high]:
                if below <= at < below + inside:
                    state.setdefault((c, low, high), []).append((k, at - below))
                else:
                    state.setdefault((c, starts[c].low, starts[c].high), []).append((k, at))
    while state:
        for c, low, high in [r for r in state if r[1] == r[2]]:
            found.update({(c, k): low for k, _ in state.pop((c, low, high))})
        ranges = list(state)
        bins = _bins_of(df, ranges) if ranges else {}
        following: dict = {}
        for i, r in enumerate(ranges):
            for k, left in state[r]:
                for n, low, high in bins[i]:
                    if left < n:
                        following.setdefault((r[0], low, high), []).append((k, left))
                        break
                    left -= n
        state = following
    return found


def _sketched_range(start, at: int, shares: list[float]) -> tuple[float, float] | None:
    """The sketched values around the share that is nearest to a place; None without a sketch."""
    if not start.sketched:
        return None
    nearest = min(range(len(shares)), key=lambda i: abs(shares[i] - at / max(1, start.n - 1)))
    return start.sketched[2 * nearest], start.sketched[2 * nearest + 1]


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """One row per column with ``q_0 .. q_k``: linear interpolation, exact. Columns without values have none."""
    starts = _starts(df, columns, shares)
    places = {c: [share * (starts[c].size - 1) for share in shares] for c in columns if starts[c].size}
    wanted = {c: {k for p in ps for k in (math.floor(p), math.ceil(p))} for c, ps in places.items()}
    found = order_statistics(df, wanted, starts, shares) if wanted else {}
    rows = []
    for c, ps in places.items():
        ends = [(found[c, math.floor(p)], found[c, math.ceil(p)], p - math.floor(p)) for p in ps]
        rows.append((c, *[low if low == high else low + (high - low) * part for low, high, part in ends]))
    names = ", ".join(f"q_{i} double" for i in range(len(shares)))
    return df.sparkSession.createDataFrame(rows, f"variable string, {names}")
