"""Feature engineering: imputation, rare levels, binning and ordinal codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.functions.columns import hash_unit
from wareloom.operators.fitted import few_levels, freeze_levels, is_small, level_table, with_level
from wareloom.operators.levels import level_counts
from wareloom.operators.ranks import running_totals
from wareloom.operators.steps import Decision, Step


class RandomSampleImpute(Decision):
    """Fill nulls with a random observed value, chosen by a seeded hash of the id.

    A value is drawn with its share of the fitted rows; the same row always
    draws the same value.
    """

    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        if not columns:
            return DrawValues(columns=[])
        cum = running_totals(level_counts(df, columns), ["variable"], ["value"], {"cum": "n"})
        sizes = cum.groupBy("variable").agg(F.max("cum").alias("total"))
        ranges = cum.join(F.broadcast(sizes), "variable").select(
            "variable",
            "value",
            ((F.col("cum") - F.col("n")) / F.col("total")).alias("low"),
            (F.col("cum") / F.col("total")).alias("high"),
        )
        return DrawValues(
            columns=columns,
            key=self.option("key"),
            seed=self.option("seed", 25),
            levels=freeze_levels(ranges, "draws"),
        )


class DrawValues(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.option("columns"):
            if c in df.columns:
                df = self._draw(df, c)
        return df

    def _draw(self, df: DataFrame, c: str) -> DataFrame:
        levels = self.option("levels")
        kind = df.schema[c].dataType
        u = hash_unit(F.col(self.option("key")), f"{self.option('seed')}:{c}")
        known = few_levels(levels, c)
        if known is not None:
            drawn: Column = F.lit(None).cast("string")
            for value, _, high in sorted(known, key=lambda r: -r[2]):
                drawn = F.when(u < high, value).otherwise(drawn)
            return df.withColumn(c, F.coalesce(F.col(c), drawn.cast(kind)))

        # The unit range cut into as many buckets as there are levels; a level sits in every bucket it
        # touches, so the range lookup is an equi-join on the bucket with about two levels each.
        buckets = levels["sizes"][c]
        first = F.floor(F.col("low") * buckets)
        last = F.least(F.ceil(F.col("high") * buckets) - 1, F.lit(buckets - 1))
        table = level_table(df.sparkSession, levels, c).select(
            F.col("value").alias("_value"),
            F.col("low").alias("_low"),
            F.col("high").alias("_high"),
            F.explode(F.sequence(first, F.greatest(first, last))).alias("_bucket"),
        )
        if is_small(levels, c):
            table = F.broadcast(table)  # its size was checked at fit
        # One left join keeps every row. Rows with a value get negative keys, which match nothing and
        # spread over as many tasks as the buckets.
        spread = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(buckets))
        keyed = df.withColumn("_u", u).withColumn(
            "_at", F.when(F.col(c).isNull(), F.floor(F.col("_u") * buckets)).otherwise(spread)
        )
        within = (F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high"))
        joined = keyed.join(table, (F.col("_at") == F.col("_bucket")) & within, "left")
        filled = F.coalesce(F.col(c), F.col("_value").cast(kind)).alias(c)
        return joined.select(*[filled if n == c else F.col(n) for n in df.columns])


class RareLabels(Decision):
    """Levels below ``tol`` become "Rare" in columns with more than ``n_categories``.

    At most ``1 / tol`` levels can reach the tolerance, so the kept levels are
    few for any cardinality.
    """

    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        tol, few = self.option("tol", 0.05), self.option("n_categories", 10)
        if not columns:
            return GroupRare(frequent={})
        counts = level_counts(df, columns)
        totals = counts.groupBy("variable").agg(
            F.sum("n").alias("total"), F.count("*").alias("n_levels")
        )
        kept = (
            counts.join(F.broadcast(totals), "variable")
            .where((F.col("n_levels") <= few) | (F.col("n") / F.col("total") >= tol))
            .select("variable", "value")
            .collect()
        )
        frequent = {c: sorted(r.value for r in kept if r.variable == c) for c in columns}
        return GroupRare(frequent=frequent, replacement=self.option("replacement", "Rare"))


class GroupRare(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        grouped = {}
        for c, values in self.option("frequent").items():
            if c not in df.columns:
                continue
            text = F.col(c).cast("string")
            known = text.isin(*values) if values else F.lit(False)
            grouped[c] = F.when(text.isNull() | known, text).otherwise(self.option("replacement"))
        return df.withColumns(grouped) if grouped else df


def geometric_edges(low: float, high: float, bins: int, precision: int = 7) -> list[float]:
    """Inner edges low + g, low + g^2, ... with g^bins spanning the range."""
    growth = (high - low) ** (1.0 / bins)
    return sorted(round(low + growth**i, precision) for i in range(1, bins))


def bin_index(c: Column, edges: list[float]) -> Column:
    """Bins closed on the right: a value on an edge stays below it."""
    index = sum(((c > edge).cast("int") for edge in edges), F.lit(0))
    return F.when(c.isNotNull(), index)


class GeometricBins(Decision):
    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        bins = self.option("bins", 8)
        if not columns:
            return CutBins(edges={})
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"low_{i}") for i, c in enumerate(columns)],
            *[F.max(F.col(c).cast("double")).alias(f"high_{i}") for i, c in enumerate(columns)],
        ).first()
        edges = {
            c: geometric_edges(row[f"low_{i}"], row[f"high_{i}"], bins)
            for i, c in enumerate(columns)
            if row[f"low_{i}"] is not None
        }
        return CutBins(edges=edges)


class CutBins(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        cut = {
            c: bin_index(F.col(c).cast("double"), edges)
            for c, edges in self.option("edges").items()
            if c in df.columns
        }
        return df.withColumns(cut) if cut else df


def ordered_levels(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(variable, value, n, mean_label): target mean per level of each column."""
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [label], columns, "variable", "value"
    )
    return (
        long.where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count("*").alias("n"), F.avg(label).alias("mean_label"))
    )


def ordered_codes(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(variable, value, n, mean_label, code): levels ranked by target mean, then name."""
    levels = ordered_levels(df, columns, label).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(levels, ["variable"], ["mean_label", "value"], {"rank": "one"})
    return ranked.select(
        "variable", "value", "n", "mean_label", (F.col("rank") - 1).cast("double").alias("code")
    )


class TargetOrder(Decision):
    """Ordinal codes by target mean; nulls and unseen levels stay null."""

    def _fit(self, df: DataFrame) -> Step:
        columns = [c for c in self.option("columns") if c in df.columns]
        if not columns:
            return ApplyCodes(columns=[])
        codes = ordered_codes(df, columns, self.option("label", "label"))
        levels = freeze_levels(codes.select("variable", "value", "n", "code"), "codes")
        return ApplyCodes(columns=columns, levels=levels)


class ApplyCodes(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        levels = self.option("levels")
        inline = {}
        for c in self.option("columns"):
            known = few_levels(levels, c)
            if c in df.columns and known is not None:
                inline[c] = self._inline(F.col(c).cast("string"), known)
        looked_up = [c for c in self.option("columns") if c in df.columns and c not in inline]
        if inline:
            df = df.withColumns(inline)
        for c in looked_up:
            names = df.columns
            coded = with_level(df, levels, c, F.col(c).cast("string"), F.col("code"), "_code")
            df = coded.select(*[F.col("_code").alias(c) if n == c else F.col(n) for n in names])
        return df

    @staticmethod
    def _inline(text: Column, known: list[list]) -> Column:
        if not known:
            return F.lit(None).cast("double")
        pairs = [F.lit(part) for value, _, code in known for part in (value, float(code))]
        return F.try_element_at(F.create_map(*pairs), text)
