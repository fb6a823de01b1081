"""From one row per product to a trained and evaluated classifier."""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.operators.clean import DropColumns, FlagsToText
from wareloom.operators.decide import variable_kinds
from wareloom.operators.engineer import GeometricBins, RandomSampleImpute, RareLabels, TargetOrder
from wareloom.operators.evaluate import log_loss, roc_auc
from wareloom.operators.select import DropCorrelated, DropQuasiConstant, MatchCategories, MatchColumns
from wareloom.operators.split import EncodeLabel, StratifiedSplit
from wareloom.operators.train import cross_validate, scored, train
from wareloom.settings import BoostingParams, EngineeringLists, EngineeringParams, SearchSpace, Settings
from wareloom.sources.store import materialize

# Columns that describe a row and are never a feature.
CARRIED = ["split", "label"]


def carried(key: str, target: str) -> list[str]:
    return [key, target, *CARRIED]


def training_rows(df: DataFrame) -> DataFrame:
    return df.where("split = 'train'")


def split_and_label(df: DataFrame, key: str, target: str, seed: int = 25) -> DataFrame:
    """Adds ``split`` and ``label``; written once because every fit reads it.

    The passes that find the cuts read a written copy of two columns, so an
    expensive ``df`` is evaluated twice and not once per pass.
    """
    narrow = materialize(df.select(key, target), "classes")
    splitter = StratifiedSplit(target=target, key=key, seed=seed).fit(narrow)
    encoder = EncodeLabel(target=target).fit(training_rows(splitter.transform(narrow)))
    return materialize(encoder.transform(splitter.transform(df)), "labelled")


def selection_pipeline(train_rows: DataFrame, key: str, target: str, settings: Settings = Settings()) -> Pipeline:
    """Drop configured, near-constant and correlated columns; align the rest."""
    skip = carried(key, target)
    kinds = variable_kinds(train_rows, exclude=tuple(skip))
    lists = settings.selection
    configured = [*lists.categoricals_more_than_threshold, *lists.high_cardinality_from_eda]
    watched = [c for c in kinds["continuous"] + kinds["categorical"] if c not in configured]
    return Pipeline(
        stages=[
            DropColumns(columns=configured),
            DropQuasiConstant(columns=watched, tol=0.95),
            MatchColumns(keep=skip),
            DropCorrelated(columns=kinds["continuous"], threshold=0.8),
            MatchCategories(skip=skip),
        ]
    )


def engineered_kinds(train_rows: DataFrame, key: str, target: str) -> dict[str, list[str]]:
    return variable_kinds(FlagsToText().transform(train_rows), exclude=tuple(carried(key, target)))


def engineering_pipeline(
    train_rows: DataFrame,
    key: str,
    target: str,
    lists: EngineeringLists = EngineeringLists(),
    params: EngineeringParams = EngineeringParams(),
    seed: int = 25,
    kinds: dict[str, list[str]] | None = None,
) -> tuple[Pipeline, list[str]]:
    """Impute, group rare levels, bin numbers, encode by target order.

    ``kinds`` of the columns are looked up in the rows unless given.
    """
    kinds = kinds or engineered_kinds(train_rows, key, target)
    features = kinds["continuous"] + kinds["categorical"]
    pipeline = Pipeline(
        stages=[
            FlagsToText(),
            RandomSampleImpute(columns=list(lists.categoricals_less_than_threshold), key=key, seed=seed),
            RareLabels(columns=list(lists.categoricals_high_cardinality), tol=0.05, n_categories=params.n_cat_high),
            RareLabels(columns=list(lists.categoricals_low_cardinality), tol=0.05, n_categories=params.n_cat_low),
            GeometricBins(columns=kinds["continuous"], bins=params.bins),
            TargetOrder(columns=features, label="label"),
        ]
    )
    return pipeline, features + kinds["discrete"]


def fit_on_train(pipeline: Pipeline, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows, transform the whole frame once."""
    model = pipeline.fit(training_rows(df))
    return model, model.transform(df)


@dataclass
class Trained:
    selection: PipelineModel
    engineering: PipelineModel
    model: PipelineModel
    features: list[str]
    matrix: DataFrame
    scores: DataFrame


def prepare_matrix(
    entities: DataFrame, key: str, target: str, settings: Settings = Settings()
) -> tuple[PipelineModel, PipelineModel, list[str], DataFrame]:
    """Split, select and engineer; the result is written for the many tree passes."""
    labelled = split_and_label(entities, key, target, settings.seed)
    selection, selected = fit_on_train(
        selection_pipeline(training_rows(labelled), key, target, settings), labelled
    )
    pipeline, features = engineering_pipeline(
        training_rows(selected), key, target, settings.engineering, settings.engineering_params, settings.seed
    )
    engineering, encoded = fit_on_train(pipeline, selected)
    return selection, engineering, features, materialize(encoded, "matrix")


def train_flow(entities: DataFrame, key: str, target: str, settings: Settings = Settings()) -> Trained:
    selection, engineering, features, matrix = prepare_matrix(entities, key, target, settings)
    model = train(matrix, features, settings.boosting)
    return Trained(selection, engineering, model, features, matrix, scored(model, matrix))


def split_metrics(scores: DataFrame) -> DataFrame:
    """(split, auc, log_loss) with "used" as the positive class."""
    auc = roc_auc(scores, "p1", "label", ["split"])
    return auc.join(log_loss(scores, "p1", "label", ["split"]), "split").withColumn(
        "positive_class", F.lit("used")
    )


def search_engineering(
    selected: DataFrame,
    key: str,
    target: str,
    boosting: BoostingParams = BoostingParams(),
    lists: EngineeringLists = EngineeringLists(),
    space: SearchSpace = SearchSpace(),
    trials: int = 50,
    folds: int = 10,
    patience: int = 10,
    seed: int = 25,
    parallelism: int = 2,
) -> DataFrame:
    """(trial, n_cat_high, n_cat_low, bins, best_round, auc) of random settings."""
    rng = random.Random(seed)
    base = EngineeringParams()
    tried = [
        replace(
            base,
            n_cat_high=rng.randint(*space.n_cat_high),
            n_cat_low=rng.randint(*space.n_cat_low),
            bins=rng.randint(*space.bins),
        )
        for _ in range(trials)
    ]

    kinds = engineered_kinds(training_rows(selected), key, target)

    def one(item: tuple[int, EngineeringParams]) -> tuple:
        number, params = item
        pipeline, features = engineering_pipeline(training_rows(selected), key, target, lists, params, seed, kinds)
        _, encoded = fit_on_train(pipeline, selected)
        matrix = materialize(encoded, "trial")
        curve = cross_validate(matrix, features, boosting, key, folds, patience, parallelism=1)
        best = curve.where("best").first()
        values = asdict(params)
        return number, values["n_cat_high"], values["n_cat_low"], values["bins"], best["round"], best.auc

    with ThreadPool(parallelism) as pool:
        rows = pool.map(one, list(enumerate(tried)))
    return selected.sparkSession.createDataFrame(
        rows, "trial int, n_cat_high int, n_cat_low int, bins int, best_round int, auc double"
    ).orderBy(F.col("auc").desc(), "trial")
