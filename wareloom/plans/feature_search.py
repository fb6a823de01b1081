"""Search of engineering parameters by cross-validated boosting.

Trials are drawn by a Parzen sampler. Their stages are fitted in a trie, so trials
that differ only in bins share imputation and rare levels, and trials whose stages come
out alike are one matrix. The matrices of a generation stand side by side as columns
of one table, and the folds of all of them grow in the same scans.
"""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.operators import boost
from wareloom.operators.search import Dimension, suggest
from wareloom.operators.split import StratifiedFolds
from wareloom.operators.stage_trie import Node, StageTrie
from wareloom.operators.train import with_weight
from wareloom.plans.training import engineered_kinds, engineering_pipeline, training_rows
from wareloom.settings import EngineeringLists, EngineeringParams, SearchSpace
from wareloom.sources.store import materialize

#: Boosting parameters that the search of engineering parameters is judged with.
PLAIN_BOOSTING = boost.TreeParams(
    step_size=0.1, min_child_weight=1, subsample=1.0, feature_share=1.0, alpha=0.0, lambda_=1.0, rounds=300
)


@dataclass(frozen=True)
class Matrix:
    """An engineered matrix: its place among the trie's leaves, its best round and the mean area there."""

    number: int
    best_round: int
    auc: float


@dataclass
class FeatureTrials:
    """(parameters, matrix) of every trial, and the trie that their stages were fitted in."""

    trials: list[tuple[EngineeringParams, Matrix]]
    trie: StageTrie
    scans: int

    def table(self, spark) -> DataFrame:
        """(trial, n_cat_high, n_cat_low, bins, matrix, best_round, auc), best first."""
        rows = [
            (i, *asdict(p).values(), m.number, m.best_round, m.auc) for i, (p, m) in enumerate(self.trials)
        ]
        rows.sort(key=lambda r: (-r[-1], r[0]))
        names = ", ".join(f"{n} int" for n in asdict(EngineeringParams()))
        return spark.createDataFrame(rows, f"trial int, {names}, matrix int, best_round int, auc double")


def side_by_side(rows: DataFrame, leaves: list[Node], features: list[str], kept: list[str]) -> DataFrame:
    """``kept`` columns and, per leaf, the features after its stages as ``_m{place}_{feature}``."""
    raw = [c for c in rows.columns if c not in kept]
    wide = rows.select(*kept, F.struct(*raw).alias("_raw"))
    done: list[str] = []
    for place, leaf in enumerate(leaves):
        out = wide.select(*kept, "_raw", *done, *[F.col("_raw")[c].alias(c) for c in raw])
        for stage in leaf.stages:
            out = stage.transform(out)
        own = {c: f"_m{place}_{c}" for c in features}
        wide = out.select(*kept, "_raw", *done, *[F.col(c).cast("double").alias(n) for c, n in own.items()])
        done += own.values()
    return wide.drop("_raw")


def search_features(
    selected: DataFrame,
    key: str,
    target: str,
    boosting: boost.TreeParams = PLAIN_BOOSTING,
    lists: EngineeringLists = EngineeringLists(),
    space: SearchSpace = SearchSpace(),
    trials: int = 50,
    at_once: int = 10,
    folds: int = 10,
    patience: int | None = 10,
    seed: int = 25,
) -> FeatureTrials:
    """Trials of (n_cat_high, n_cat_low, bins), each judged by its best mean area over stratified folds."""
    rng = random.Random(seed)
    ranges = {n: Dimension(*getattr(space, n), whole=True) for n in ("n_cat_high", "n_cat_low", "bins")}
    kinds = engineered_kinds(training_rows(selected), key, target)
    rows = with_weight(selected.where(F.col("split").isin("train", "val")))
    rows = materialize(StratifiedFolds(target="label", key=key, folds=folds, seed=seed).fit(rows).transform(rows), "folds")
    trie = StageTrie(training_rows(rows))
    known: dict[int, Matrix] = {}
    done: list[tuple[EngineeringParams, Matrix]] = []
    scans = 0
    while len(done) < trials:
        finished = [(asdict(p), m.auc) for p, m in done]
        drawn = [EngineeringParams(**suggest(ranges, finished, rng)) for _ in range(min(at_once, trials - len(done)))]
        ends = []
        for params in drawn:
            pipeline, features = engineering_pipeline(trie.root.rows, key, target, lists, params, seed, kinds)
            ends.append(trie.fit(pipeline.getStages()))
        fresh = list({id(n): n for n in ends if id(n) not in known}.values())
        if fresh:
            kept = [key, "label", "weight", "fold"]
            wide = side_by_side(rows, fresh, features, kept)
            columns = [c for c in wide.columns if c not in kept]
            wide = materialize(wide, "matrices")
            width, everything = len(features), frozenset(range(folds))
            members = [
                boost.Member(boosting, list(range(p * width, (p + 1) * width)), everything - {k}, frozenset([k]))
                for p in range(len(fresh))
                for k in range(folds)
            ]
            state = boost.start(wide, columns, members, boost.fit_cuts(wide, columns), key, F.col("fold"))
            groups = [list(range(p * folds, (p + 1) * folds)) for p in range(len(fresh))]
            for node, means in zip(fresh, boost.grow_folds(state, groups, patience, boosting.rounds)):
                best = boost.best_of([r["auc"] for r in means])
                known[id(node)] = Matrix(len(known), best, means[best]["auc"])
            scans += state.scans
        done += [(p, known[id(n)]) for p, n in zip(drawn, ends)]
    return FeatureTrials(done, trie, scans)
