"""Stratified splits, labels, folds and sample weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.functions.columns import hash_text
from wareloom.operators.steps import Decision, Step

# A target with more classes is no classification target; their names go to the driver.
MAX_CLASSES = 1000
PREFIX_STEP = 3  # hexadecimal digits looked at per refinement: 4096 ranges


def class_sizes(df: DataFrame, column: str) -> dict:
    """Rows per class, null as a class; refuses a column with too many values."""
    rows = df.groupBy(F.col(column).alias("class")).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{column} has more than {MAX_CLASSES} classes")
    return {r["class"]: r.n for r in rows}


def allocate(counts: dict, total: int) -> dict:
    """Split ``total`` over classes in proportion, largest remainder first."""
    size = sum(counts.values())
    exact = {c: total * n / size for c, n in counts.items()}
    share = {c: int(exact[c]) for c in counts}
    order = sorted(counts, key=lambda c: (-(exact[c] - share[c]), -counts[c], str(c)))
    for c in order[: total - sum(share.values())]:
        share[c] += 1
    return share


def split_sizes(counts: dict, shares: tuple[float, float] = (0.6, 0.2)) -> dict:
    """Per class the number of train and validation rows; the rest is test.

    Two steps: the held-out part first (rounded up), then its halves.
    """
    total = sum(counts.values())
    held_total = _ceil(total * (1 - shares[0]))
    train = allocate(counts, total - held_total)
    held = {c: counts[c] - train[c] for c in counts}
    test_total = _ceil(held_total * (1 - shares[1] / (1 - shares[0])))
    val = allocate(held, held_total - test_total)
    return {c: (train[c], val[c]) for c in counts}


def _ceil(x: float) -> int:
    whole = int(x)
    return whole if x - whole < 1e-9 else whole + 1


def rank_cut(hashed: DataFrame, classes: dict, digits: int = PREFIX_STEP) -> dict:
    """Per (class, cut) the hash below which exactly ``k`` rows lie.

    Finds an order statistic without sorting: each pass counts rows by the next
    digits of the hash inside the one range that still holds the cut. Hashes
    are uniform, so the range shrinks by 4096 per pass until few rows remain.
    """
    # state: (class, cut) -> (prefix settled so far, rows still wanted below)
    state = {(c, i): ("", k) for c, ks in classes.items() for i, k in enumerate(ks)}
    done: dict = {}
    while state:
        length = len(next(iter(state.values()))[0]) + digits
        wanted = F.lit(False)
        for (c, _), (prefix, _k) in state.items():
            wanted = wanted | (F.col("class").eqNullSafe(F.lit(c)) & F.col("hash").startswith(prefix))
        # At most classes * cuts * 4096 rows.
        ranges = (
            hashed.where(wanted)
            .groupBy("class", F.substring("hash", 1, length).alias("prefix"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        following = {}
        for (c, i), (prefix, k) in state.items():
            inside = sorted((r.prefix, r.n) for r in ranges if r["class"] == c and r.prefix.startswith(prefix))
            for name, n in inside:
                if k <= 0:
                    done[(c, i)] = name  # nothing of this range is taken
                    break
                if n <= k:
                    k -= n
                    continue
                if length >= 32:
                    done[(c, i)] = name
                    break
                following[(c, i)] = (name, k)
                break
            else:
                done[(c, i)] = prefix + "g"  # above every hexadecimal digit: all rows
        state = following
    return done


class StratifiedSplit(Decision):
    """Adds ``split``: train, val or test, in exact class proportions.

    Rows are ordered by a seeded hash of their id inside each class. Only the
    two cut hashes per class are kept, so splitting a row needs no shuffle and
    no other row.
    """

    def _fit(self, df: DataFrame) -> Step:
        target, key = self.option("target"), self.option("key")
        seed = self.option("seed", 25)
        hashed = df.select(F.col(target).alias("class"), hash_text(F.col(key), seed).alias("hash"))
        counts = class_sizes(hashed, "class")
        sizes = split_sizes(counts, tuple(self.option("shares", (0.6, 0.2))))
        cuts = rank_cut(hashed, {c: [t, t + v] for c, (t, v) in sizes.items()})
        table = [[c, cuts[(c, 0)], cuts[(c, 1)]] for c in counts]
        return AssignSplit(target=target, key=key, seed=seed, cuts=table)


class AssignSplit(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        code = hash_text(F.col(self.option("key")), self.option("seed"))
        split: Column = F.lit(None).cast("string")
        for value, first, second in self.option("cuts"):
            here = F.col(self.option("target")).eqNullSafe(F.lit(value))
            part = F.when(code < first, "train").when(code < second, "val").otherwise("test")
            split = F.when(here, part).otherwise(split)
        return df.withColumn("split", split)


class EncodeLabel(Decision):
    """Adds ``label``: the rank of the class name; an unseen class is an error."""

    def _fit(self, df: DataFrame) -> Step:
        target = self.option("target")
        classes = class_sizes(df.where(F.col(target).isNotNull()), target)
        return ApplyLabel(target=target, classes=sorted(classes))


class ApplyLabel(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        target = F.col(self.option("target"))
        code = F.raise_error(F.concat(F.lit("unseen class: "), F.coalesce(target.cast("string"), F.lit("null"))))
        code = code.cast("double")
        for i, value in enumerate(self.option("classes")):
            code = F.when(target == value, float(i)).otherwise(code)
        return df.withColumn("label", code)


class ClassWeights(Decision):
    """Adds ``weight``: the relative frequency of the row's class.

    ``inverse`` gives rare classes the larger weight instead.
    """

    def _fit(self, df: DataFrame) -> Step:
        label = self.option("label", "label")
        counts = class_sizes(df.where(F.col(label).isNotNull()), label)
        total = sum(counts.values())
        inverse = self.option("inverse", False)
        table = sorted([c, total / (len(counts) * n) if inverse else n / total] for c, n in counts.items())
        return ApplyWeights(label=label, weights=table)


class ApplyWeights(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        label = F.col(self.option("label"))
        weight: Column = F.lit(None).cast("double")
        for value, w in self.option("weights"):
            weight = F.when(label == value, w).otherwise(weight)
        return df.withColumn("weight", weight)


class StratifiedFolds(Decision):
    """Adds ``fold`` 0..k-1, class proportions exact in every fold."""

    def _fit(self, df: DataFrame) -> Step:
        target, key = self.option("target", "label"), self.option("key")
        seed, folds = self.option("seed", 25), self.option("folds", 10)
        hashed = df.select(F.col(target).alias("class"), hash_text(F.col(key), seed).alias("hash"))
        counts = class_sizes(hashed, "class")
        wanted = {c: [n * (i + 1) // folds for i in range(folds - 1)] for c, n in counts.items()}
        cuts = rank_cut(hashed, wanted)
        table = [[c, [cuts[(c, i)] for i in range(folds - 1)]] for c in counts]
        return AssignFold(target=target, key=key, seed=seed, cuts=table)


class AssignFold(Step):
    def _transform(self, df: DataFrame) -> DataFrame:
        code = hash_text(F.col(self.option("key")), self.option("seed"))
        fold: Column = F.lit(None).cast("int")
        for value, cuts in self.option("cuts"):
            here = F.col(self.option("target")).eqNullSafe(F.lit(value))
            number = sum(((code >= cut).cast("int") for cut in cuts), F.lit(0))
            fold = F.when(here, number).otherwise(fold)
        return df.withColumn("fold", fold)
