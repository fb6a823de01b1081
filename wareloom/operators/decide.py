"""Schema decisions taken from the data: one aggregation each, frozen at fit.

Only numbers bounded by the column count reach the driver.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.columns import is_digit_text
from wareloom.operators.clean import CastNumbers, DropColumns, text_columns
from wareloom.operators.levels import level_counts
from wareloom.operators.steps import Decision, Step


def null_ratio(c: str) -> Column:
    return F.avg(F.col(c).isNull().cast("double"))


def null_ratios(df: DataFrame) -> dict[str, float]:
    """Counts of filled cells: one buffer per column keeps the pass in generated code."""
    filled = [F.count(c).alias(f"filled_{i}") for i, c in enumerate(df.columns)]
    row = df.agg(F.count("*").alias("total"), *filled).first()
    if not row.total:
        return dict.fromkeys(df.columns, 0.0)
    return {c: (row.total - row[f"filled_{i}"]) / row.total for i, c in enumerate(df.columns)}


def comparable_pairs(df: DataFrame) -> list[tuple[str, str]]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [(a, b) for a, b in combinations(df.columns, 2) if kinds[a] == kinds[b]]


#: Rows looked at for proof that two columns differ.
WITNESS_ROWS = 500


def same_value(a, b) -> bool:
    """Equality as in SQL, where not-a-number equals itself."""
    return a == b or (a != a and b != b)


def undecided_pairs(df: DataFrame, pairs: list[tuple[str, str]], rows: int = WITNESS_ROWS) -> list[tuple[str, str]]:
    """The pairs for which none of the first rows met shows two different values.

    One row with different values settles a pair for good, so nothing is guessed
    from these rows: they only spare the full pass the pairs that differ almost
    everywhere. A bounded number of rows comes to the driver.
    """
    met = [r.asDict(recursive=True) for r in df.select(*dict.fromkeys(c for p in pairs for c in p)).limit(rows).collect()] if pairs else []
    values = {c: [r[c] for r in met] for c in dict.fromkeys(c for p in pairs for c in p)}

    def differ(a: str, b: str) -> bool:
        return any(x is not None and y is not None and not same_value(x, y) for x, y in zip(values[a], values[b]))

    return [(a, b) for a, b in pairs if not differ(a, b)]


def duplicate_columns(df: DataFrame, require_overlap: bool = False, empty_equals_all: bool = False) -> list[str]:
    """Columns equal to an earlier one of the same type wherever both have a value.

    Two columns never filled in the same row count as equal unless
    ``require_overlap``. A column without any value equals other empty columns of
    its type only; with ``empty_equals_all`` it equals every column of its type.
    Pairs that a few rows prove different are left out of the one pass over all rows.
    """
    pairs = comparable_pairs(df)
    open_pairs = undecided_pairs(df, pairs)
    filled = [F.count(c).alias(f"filled_{i}") for i, c in enumerate(df.columns)]
    same = [
        F.coalesce(F.bool_and(F.col(a) == F.col(b)), F.lit(not require_overlap)).alias(f"same_{i}")
        for i, (a, b) in enumerate(open_pairs)
    ]
    row = df.agg(*filled, *same).first()
    empty = {c for i, c in enumerate(df.columns) if row[f"filled_{i}"] == 0}
    same_pairs = {pair for i, pair in enumerate(open_pairs) if row[f"same_{i}"]}

    def equal(a: str, b: str) -> bool:
        if a in empty and b in empty:
            return True
        if a in empty or b in empty:
            return empty_equals_all
        return (a, b) in same_pairs

    found = {b for a, b in pairs if equal(a, b)}
    return [c for c in df.columns if c in found]


class DropDuplicateColumns(Decision):
    def _fit(self, df: DataFrame) -> Step:
        found = duplicate_columns(
            df, self.option("require_overlap", False), self.option("empty_equals_all", False)
        )
        return DropColumns(columns=found)


class DropSparseColumns(Decision):
    """Drop columns whose share of nulls exceeds ``threshold``."""

    def _fit(self, df: DataFrame) -> Step:
        threshold = self.option("threshold", 1 / 3)
        ratios = null_ratios(df)
        return DropColumns(columns=[c for c in df.columns if ratios[c] > threshold])


class DetectNumbers(Decision):
    """Text columns holding only digits (with one dot at most) become doubles.

    Names containing ``id`` are identifiers and stay text. Every value is
    looked at: the first rows of a distributed table are no fixed sample.
    """

    def _fit(self, df: DataFrame) -> Step:
        candidates = [c for c in text_columns(df) if "id" not in c.lower()]
        if not candidates:
            return CastNumbers(columns=[])
        # All-null columns give null here and are left alone.
        row = df.agg(*[F.bool_and(is_digit_text(F.col(c))).alias(c) for c in candidates]).first()
        return CastNumbers(columns=[c for c in candidates if row[c]])


NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)
CATEGORICAL = (T.StringType, T.BooleanType)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, n_unique, has_null): exact distinct non-null values per column."""
    return (
        level_counts(df, columns, nulls=True)
        .groupBy("variable")
        .agg(F.count("value").alias("n_unique"), F.max(F.col("value").isNull()).alias("has_null"))
    )


def columns_within(df: DataFrame, columns: list[str], limit: int, count_null: bool) -> set[str]:
    """Columns with at most ``limit`` distinct values, exactly.

    A sketch first sets aside the columns that are far above the limit (over
    ``20 * limit + 100``, many times its error), so their values are never
    shuffled; the rest is counted exactly.
    """
    if not columns:
        return set()
    sketch = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    near = [c for c in columns if sketch[c] <= 20 * limit + 100]
    if not near:
        return set()
    counts = distinct_counts(df, near).collect()
    return {
        r.variable for r in counts if r.n_unique + (1 if count_null and r.has_null else 0) <= limit
    }


def variable_kinds(df: DataFrame, exclude: tuple[str, ...] = (), limit: int = 5) -> dict[str, list[str]]:
    """Continuous, categorical, discrete and temporal columns.

    A number with at most ``limit`` distinct values (null is one) is discrete.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    discrete = columns_within(df, numeric, limit, count_null=True)
    return {
        "continuous": [c for c in numeric if c not in discrete],
        "categorical": [f.name for f in fields if isinstance(f.dataType, CATEGORICAL)],
        "discrete": [c for c in numeric if c in discrete],
        "temporal": [f.name for f in fields if isinstance(f.dataType, TEMPORAL)],
    }


def variable_info(
    df: DataFrame,
    continuous: list[str] | None = None,
    categoricals: list[str] | None = None,
    discretes: list[str] | None = None,
    missing_threshold: float = 0.05,
    cardinality_threshold: int = 5,
) -> dict[str, list[str]]:
    """Columns by share of nulls and, for categories and discretes, by cardinality."""
    groups = {"continuous": continuous, "categoricals": categoricals, "discretes": discretes}
    asked = [c for columns in groups.values() for c in columns or []]
    ratios = null_ratios(df.select(*asked)) if asked else {}
    low = columns_within(
        df, (categoricals or []) + (discretes or []), cardinality_threshold, count_null=False
    )
    info = {}
    for kind, columns in groups.items():
        if columns is None:
            continue
        info[f"{kind}_more_than_threshold"] = [c for c in columns if ratios[c] > missing_threshold]
        info[f"{kind}_less_than_threshold"] = [
            c for c in columns if 0 < ratios[c] <= missing_threshold
        ]
        if kind != "continuous":
            info[f"{kind}_high_cardinality"] = [c for c in columns if c not in low]
            info[f"{kind}_low_cardinality"] = [c for c in columns if c in low]
    return info
