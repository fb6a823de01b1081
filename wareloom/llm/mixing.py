"""Mixing sources to target weights by temperature.

A source's natural share ``p`` becomes the weight ``p^a / sum(p^a)``. The exponent
is bisected until the weights meet a target entropy or no source is repeated more
often than allowed. A weight then is a token budget: whole passes over the source
and a part of one more. Each pass is a permutation of the source's blocks (the
documents dealt out by hash), and the last pass takes blocks in its order until
the budget is used, the block at the edge document by document, to the nearest document end.

Without a budget the smallest one that uses every document is taken: the least
repeated source is read exactly once and the others more often.

A null source is a source of its own. Documents without tokens cost nothing and
stay once. Rows equal in doc_id and text share their place in the order and are
taken or left together. Extra columns pass through; helper names avoid them. An
empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wareloom.llm.common import WORD, free_names, materialize

MAX_REPEATS = 2.0
SEED = 17
#: Exponents tried at once: 31 points are five bisection steps.
GRID = 31
WIDTH = 1e-9
LARGEST_EXPONENT = 32.0


@dataclass(frozen=True)
class Moments:
    """What a weight vector needs at one exponent: sums of ``q^a`` and ``q^a ln q``, q relative to the largest source."""

    a: float
    power_sum: float
    log_sum: float

    def entropy(self) -> float:
        return math.log(self.power_sum) - self.a * self.log_sum / self.power_sum


def moments(shares: DataFrame, exponents: list[float]) -> list[Moments]:
    """One aggregation over the sources for all exponents."""
    q = F.col("q")
    row = shares.agg(
        *[F.sum(F.pow(q, F.lit(a))).alias(f"z{i}") for i, a in enumerate(exponents)],
        *[F.sum(F.pow(q, F.lit(a)) * F.ln(q)).alias(f"l{i}") for i, a in enumerate(exponents)],
    ).first()
    return [Moments(a, row[f"z{i}"], row[f"l{i}"]) for i, a in enumerate(exponents)]


def bisect_exponent(shares: DataFrame, low: float, high: float, enough) -> float:
    """Smallest exponent in the range with ``enough(moments)``; it must stay true above. The upper end if none."""
    while high - low > WIDTH:
        step = (high - low) / (GRID + 1)
        tried = moments(shares, [low + step * k for k in range(1, GRID + 1)])
        hit = next((k for k, m in enumerate(tried, 1) if enough(m)), GRID + 1)
        low, high = low + step * (hit - 1), low + step * hit
    return high


def find_exponent(
    shares: DataFrame,
    least: int,
    most: int,
    total: int,
    budget: float | None,
    max_repeats: float | None,
    target_entropy: float | None,
) -> float:
    """The exponent that meets the entropy, raised if a source would be repeated too often.

    ``least`` and ``most`` are the tokens of the smallest and the largest source.
    """

    def few_repeats(m: Moments) -> bool:
        # Passes are proportional to q^(a-1): below 1 the smallest source has the most, the largest the fewest.
        if budget is None:
            passes = (least / most) ** (m.a - 1)
        else:
            passes = (least / most) ** m.a / m.power_sum * budget / least
        return passes <= max_repeats * (1 + 1e-12)

    exponent = 0.0
    if target_entropy is not None:
        flat, steep = moments(shares, [0.0, LARGEST_EXPONENT])
        if steep.entropy() >= target_entropy:
            exponent = LARGEST_EXPONENT
        elif flat.entropy() > target_entropy:
            exponent = bisect_exponent(shares, 0.0, LARGEST_EXPONENT, lambda m: m.entropy() <= target_entropy)
    if max_repeats is not None and exponent < 1:
        if budget is not None and budget > max_repeats * total:
            raise ValueError("the budget needs more repeats than are allowed")
        if not few_repeats(moments(shares, [exponent])[0]):
            exponent = bisect_exponent(shares, exponent, 1.0, few_repeats)
    return exponent


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mixture:
    """``sources``: one row per source with its weight, budget and cuts; ``blocks``: blocks per source."""

    sources: DataFrame
    blocks: int
    exponent: float


def block_order(source: Column, epoch: Column, block: Column) -> Column:
    """A block's place in the permutation of an epoch."""
    return F.xxhash64(F.lit(SEED), source, epoch.cast("long"), block)


def plan_mixture(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    budget: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
) -> Mixture:
    """Weights and cuts of all sources; ``budget`` counts words."""
    rows = materialize(
        docs.select(
            F.col(source).cast("string").alias("source"),
            word_tokens(F.col(text)).alias("n"),
            F.xxhash64(F.lit(SEED), "doc_id", text).alias("h"),
        ),
        "mix-rows",
    )
    blocks = math.isqrt(rows.count()) + 1
    sources = materialize(
        rows.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("docs")), "mix-sources"
    )
    sized = sources.where("tokens > 0")
    most, least, total = sized.agg(F.max("tokens"), F.min("tokens"), F.sum("tokens")).first()
    if total is None:
        empty = sources.select(
            "source",
            "tokens",
            "docs",
            *[F.lit(0.0).alias(c) for c in ("weight", "epochs")],
            F.lit(0).cast("long").alias("full"),
            *[F.lit(None).cast("long").alias(c) for c in ("cut_block", "cut_row")],
        )
        return Mixture(empty, blocks, 1.0)
    shares = sized.select((F.col("tokens") / most).alias("q"))
    exponent = find_exponent(shares, least, most, total, budget, max_repeats, target_entropy)
    scale = moments(shares, [exponent])[0].power_sum
    if budget is None:
        # One pass over the source that is repeated least: the largest below exponent 1, above it the smallest.
        once = most if exponent <= 1 else least
        budget = once * scale / (once / most) ** exponent

    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / most, F.lit(exponent)) / scale).otherwise(0.0)
    plan = sources.withColumn("weight", weight).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.col("weight") * budget / F.col("tokens")).otherwise(0.0)
    )
    plan = plan.withColumn("full", F.floor(F.col("epochs") + 1e-9)).withColumn(
        "rest", F.round((F.col("epochs") - F.col("full")) * F.col("tokens")).cast("long")
    )

    def known(df: DataFrame) -> DataFrame:
        """Rows of sources that have a part of a pass to fill."""
        part = plan.where("rest > 0").select(F.col("source").alias("s"), "full", "rest")
        return df.join(part, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    dealt = rows.withColumn("block", F.pmod("h", F.lit(blocks)))
    sums = dealt.groupBy("source", "block").agg(F.sum("n").alias("n"))
    ordered = known(sums).withColumn("at", block_order(F.col("source"), F.col("full") + 1, F.col("block")))
    before = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        ordered.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where("before < rest and rest <= before + n")
        .select("source", "block", F.col("at").alias("cut_block"), (F.col("rest") - F.col("before")).alias("open"))
    )
    edge = edge.withColumnRenamed("source", "s").withColumnRenamed("block", "b")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    within = Window.partitionBy("s", "b").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)
    last = (
        dealt.join(edge, same)
        .withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .where(F.col("before") + F.col("n") / 2 < F.col("open"))
        .groupBy(F.col("s").alias("t"))
        .agg(F.max("h").alias("cut_row"))
    )
    # No document of the block at the edge may fit; the blocks before it are taken all the same.
    cuts = edge.join(last, F.col("s").eqNullSafe(F.col("t")), "left").select(
        "s", "cut_block", F.coalesce("cut_row", F.lit(-(2**63))).alias("cut_row")
    )
    cut_plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest")
    return Mixture(materialize(cut_plan, "mix-plan"), blocks, exponent)


def mix(docs: DataFrame, mixture: Mixture, source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with a row for each time a document is read, and ``epoch, block, block_order, weight``.

    The plan has one row per source. It is joined without a hint: sent to all tasks
    if its written size is small, else shuffled with hot sources split at run time.
    """
    h, copies, last, key, full, cut_block, cut_row = free_names(
        docs, "_h", "_copies", "_last", "_source", "_full", "_cut_block", "_cut_row"
    )
    names = [c for c in docs.columns if c not in ("epoch", "block", "block_order", "weight")]
    plan = mixture.sources.select(
        F.col("source").alias(key),
        "weight",
        F.col("full").alias(full),
        F.col("cut_block").alias(cut_block),
        F.col("cut_row").alias(cut_row),
    )
    joined = (
        docs.select(*names)
        .withColumn(h, F.xxhash64(F.lit(SEED), "doc_id", text))
        .withColumn("block", F.pmod(h, F.lit(mixture.blocks)))
        .join(plan, F.col(source).cast("string").eqNullSafe(F.col(key)))
    )
    place = block_order(F.col(key), F.col(full) + 1, F.col("block"))
    taken = (place < F.col(cut_block)) | ((place == F.col(cut_block)) & (F.col(h) <= F.col(cut_row)))
    counted = joined.withColumn(last, (F.col(full) + F.coalesce(taken, F.lit(False)).cast("long"))).withColumn(
        copies, F.when(word_tokens(F.col(text)) == 0, F.greatest(F.lit(1).cast("long"), F.col(last))).otherwise(F.col(last))
    )
    read = counted.where(F.col(copies) > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    )
    return read.select(
        *names, "epoch", "block", block_order(F.col(key), F.col("epoch"), F.col("block")).alias("block_order"), "weight"
    )


def mix_sources(docs: DataFrame, **settings) -> DataFrame:
    """Plan and apply a mixture; settings as for :func:`plan_mixture`."""
    return mix(docs, plan_mixture(docs, **settings))
