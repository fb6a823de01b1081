"""Quality of scored rows: every metric is an aggregate over (score, label).

``label`` is 0 or 1 and ``score`` the probability of class 1 ("used").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.operators.ranks import running_totals

EPSILON = 2.220446049250313e-16
STEPS = 100  # thresholds 0.00, 0.01, ... 1.00


def score_counts(
    df: DataFrame, by: list[str], score: str, label: str, weight: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score, as rows or as their weight."""
    one = F.col(weight).cast("double") if weight else F.lit(1).cast("bigint")
    none = F.lit(0).cast("double" if weight else "bigint")
    return df.groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, one).otherwise(none)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, one).otherwise(none)).alias("neg"),
    )


def roc_auc(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: list[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Area under the ROC curve per group; tied scores count half, rows by their weight."""
    by = by or []
    cum = running_totals(score_counts(df, by, score, label, weight), by, [score], {"cum_neg": "neg"})
    below = F.col("cum_neg") - F.col("neg") / 2
    return cum.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("pos") * below), F.sum("pos").cast("double") * F.sum("neg")
        ).alias("auc")
    )


def roc_points(df: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from the highest down.

    The curve starts at the origin with an infinite threshold.
    """
    by = by or []
    counts = score_counts(df, by, score, label)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    cum = running_totals(counts, by, [F.col(score).desc()], {"tp": "pos", "fp": "neg"})
    cum = cum.withColumn("_one", F.lit(1))
    keyed = totals.withColumn("_one", F.lit(1))
    points = cum.join(F.broadcast(keyed), [*by, "_one"]).select(
        *by,
        F.col(score).alias("threshold"),
        F.try_divide("fp", "all_neg").alias("fpr"),
        F.try_divide("tp", "all_pos").alias("tpr"),
    )
    origin = totals.select(
        *by,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return origin.unionByName(points)


def row_loss(score: Column, label: Column) -> Column:
    """Negative log-likelihood of one row, the score kept off 0 and 1."""
    p = F.least(F.greatest(score, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return -(label * F.ln(p) + (1 - label) * F.ln(1 - p))


def weighted_mean(value: Column, weight: str | None) -> Column:
    return F.sum(value * F.col(weight)) / F.sum(weight) if weight else F.avg(value)


def log_loss(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    by: list[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    loss = weighted_mean(row_loss(F.col(score), F.col(label)), weight)
    return df.groupBy(*(by or [])).agg(loss.alias("log_loss"))


def confusion(
    df: DataFrame,
    threshold: float = 0.5,
    score: str = "score",
    label: str = "label",
    by: list[str] | None = None,
) -> DataFrame:
    """tp, fp, fn, tn with class 1 predicted strictly above the threshold."""
    hit = F.col(score) > threshold
    return _cells(df, hit, label, by or [])


def _cells(df: DataFrame, hit: Column, label: str, by: list[str]) -> DataFrame:
    positive = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    )


def f1_of(hits: Column, misses: Column) -> Column:
    """2 hits / (2 hits + all errors); zero when undefined."""
    return F.coalesce(F.try_divide(2.0 * hits, 2.0 * hits + misses), F.lit(0.0))


def threshold_sweep(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(step, threshold, tp, fp, fn, tn, macro_f1) for 0.00 .. 1.00, ``>=`` rule.

    Rows are counted once per interval of the grid; the rest works on at most
    101 rows.
    """
    guess = F.floor(F.col(score) * STEPS).cast("int")
    grid = 1.0 / STEPS
    # The product may land on the wrong side of a grid value: compare and move.
    step = (
        guess
        + F.when((guess + 1) * F.lit(grid) <= F.col(score), 1).otherwise(0)
        - F.when(guess * F.lit(grid) > F.col(score), 1).otherwise(0)
    )
    counts = df.groupBy(F.least(step, F.lit(STEPS)).alias("top")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) == 0).cast("bigint")).alias("neg"),
    )
    # A score in interval k is predicted positive at every threshold up to k.
    reached = counts.select(
        F.explode(F.sequence(F.lit(0), F.col("top"))).alias("step"), "pos", "neg"
    )
    # A zero row per threshold keeps those no score reaches.
    all_steps = F.explode(F.sequence(F.lit(0), F.lit(STEPS)))
    totals = counts.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    frame = totals.select(
        all_steps.alias("step"), F.lit(0).alias("pos"), F.lit(0).alias("neg"), "all_pos", "all_neg"
    )
    cells = (
        frame.unionByName(reached, allowMissingColumns=True)
        .groupBy("step")
        .agg(
            F.sum("pos").alias("tp"),
            F.sum("neg").alias("fp"),
            F.max("all_pos").alias("all_pos"),
            F.max("all_neg").alias("all_neg"),
        )
        .select(
            "step",
            (F.col("step") * F.lit(grid)).alias("threshold"),
            "tp",
            "fp",
            (F.col("all_pos") - F.col("tp")).alias("fn"),
            (F.col("all_neg") - F.col("fp")).alias("tn"),
        )
    )
    errors = F.col("fp") + F.col("fn")
    macro = (f1_of(F.col("tp"), errors) + f1_of(F.col("tn"), errors)) / 2
    return cells.withColumn("macro_f1", macro)


def best_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """The lowest threshold with the highest macro F1."""
    sweep = threshold_sweep(df, score, label)
    return sweep.orderBy(F.round("macro_f1", 12).desc(), "step").limit(1)


def classification_report(
    df: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label"
) -> DataFrame:
    """(name, precision, recall, f1, support) per class and averaged.

    Class 1 is predicted at or above the threshold, as in the sweep.
    """
    cells = _cells(df, F.col(score) >= threshold, label, [])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    wide = cells.select(
        ratio(tn, tn + fn).alias("p0"),
        ratio(tn, tn + fp).alias("r0"),
        f1_of(tn, fp + fn).alias("f0"),
        (tn + fp).alias("s0"),
        ratio(tp, tp + fp).alias("p1"),
        ratio(tp, tp + fn).alias("r1"),
        f1_of(tp, fp + fn).alias("f1"),
        (tp + fn).alias("s1"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )
    c = F.col
    total = c("s0") + c("s1")

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            s.alias("support"),
        )

    def macro(kind: str) -> Column:
        return (c(f"{kind}0") + c(f"{kind}1")) / 2

    def weighted(kind: str) -> Column:
        return ratio(c(f"{kind}0") * c("s0") + c(f"{kind}1") * c("s1"), total)

    lines = [
        line("0", c("p0"), c("r0"), c("f0"), c("s0")),
        line("1", c("p1"), c("r1"), c("f1"), c("s1")),
        line("accuracy", c("accuracy"), c("accuracy"), c("accuracy"), total),
        line("macro avg", macro("p"), macro("r"), macro("f"), total),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return wide.select(F.inline(F.array(*lines)))
