"""Feature selection: decisions fitted on the training rows, then frozen."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.operators.association import corr_pairs
from wareloom.operators.clean import DropColumns
from wareloom.operators.fitted import few_levels, freeze_levels, with_level
from wareloom.operators.levels import level_counts
from wareloom.operators.steps import Decision, Step


def modal_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(variable, share): rows of the most frequent value, nulls only in the total."""
    counts = level_counts(df, columns, nulls=True)
    top = F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    return counts.groupBy("variable").agg((top / F.sum("n")).alias("share"))


class DropQuasiConstant(Decision):
    """Drop columns whose most frequent value covers at least ``tol`` of the rows."""

    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        tol = self.option("tol", 0.95)
        shares = {r.variable: r.share for r in modal_shares(df, columns).collect()} if columns else {}
        return DropColumns(columns=[c for c in columns if shares.get(c, 0.0) >= tol])


def correlated_columns(pairs, columns: list[str], threshold: float) -> list[str]:
    """Scan in alphabetical order; drop what correlates with a kept column."""
    strong = {frozenset((r.x, r.y)) for r in pairs if r["corr"] is not None and abs(r["corr"]) > threshold}
    kept: list[str] = []
    dropped = []
    for c in sorted(columns):
        if any(frozenset((c, k)) in strong for k in kept):
            dropped.append(c)
        else:
            kept.append(c)
    return dropped


class DropCorrelated(Decision):
    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        if len(columns) < 2:
            return DropColumns(columns=[])
        pairs = corr_pairs(df, columns).collect()
        return DropColumns(columns=correlated_columns(pairs, columns, self.option("threshold", 0.8)))


class MatchColumns(Decision):
    """Give any later frame the columns of the fitted one.

    Extra columns go, missing ones appear as typed nulls. Columns in ``keep``
    pass through where present.
    """

    def _fit(self, df: DataFrame) -> Step:
        keep = self.option("keep", [])
        fitted = T.StructType([f for f in df.schema.fields if f.name not in keep])
        return AlignColumns(keep=keep, schema=fitted.json())


class AlignColumns(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = T.StructType.fromJson(json.loads(self.option("schema")))
        kept = [c for c in self.option("keep") if c in df.columns]
        wanted = [
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in fitted.fields
        ]
        return df.select(*kept, *wanted)


class MatchCategories(Decision):
    """Text values not seen at fit become null."""

    def _fit(self, df: DataFrame) -> Step:
        skip = self.option("skip", [])
        columns = self.option("columns") or [
            f.name
            for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip
        ]
        if not columns:
            return KnownCategories(columns=[])
        return KnownCategories(columns=columns, levels=freeze_levels(level_counts(df, columns), "categories"))


class KnownCategories(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        levels = self.option("levels")
        for c in self.option("columns"):
            if c not in df.columns:
                continue
            known = few_levels(levels, c)
            if known is not None:
                keep = F.col(c).isin(*[value for value, _ in known]) if known else F.lit(False)
                df = df.withColumn(c, F.when(keep, F.col(c)))
                continue
            names = df.columns
            marked = with_level(df, levels, c, F.col(c), F.lit(True), "_known")
            kept = F.when(F.col("_known"), F.col(c)).alias(c)
            df = marked.select(*[kept if name == c else F.col(name) for name in names])
        return df
