"""Column lists and parameters the training flow starts from."""

from __future__ import annotations

from dataclasses import dataclass, field

SEED = 25


@dataclass(frozen=True)
class SelectionLists:
    high_cardinality_from_eda: tuple[str, ...] = ("title", "city")
    categoricals_more_than_threshold: tuple[str, ...] = (
        "attribute_group_id",
        "attribute_group",
        "attribute_id",
    )


@dataclass(frozen=True)
class EngineeringLists:
    categoricals_less_than_threshold: tuple[str, ...] = ("state",)
    categoricals_high_cardinality: tuple[str, ...] = ("state", "listing_type")
    categoricals_low_cardinality: tuple[str, ...] = ("local_pickup", "shipping_mode")


@dataclass(frozen=True)
class EngineeringParams:
    n_cat_high: int = 2
    n_cat_low: int = 2
    bins: int = 8


@dataclass(frozen=True)
class BoostingParams:
    """Tuned values that gradient-boosted trees in Spark ML can take.

    ``min_instances`` is the nearest match to a minimum child weight; leaf
    regularisation has no counterpart.
    """

    max_depth: int = 6
    step_size: float = 0.09945811829216437
    min_instances: int = 3
    subsample: float = 0.9603898382520749
    feature_share: float = 0.7536836580146604
    rounds: int = 93
    seed: int = SEED


@dataclass(frozen=True)
class SearchSpace:
    n_cat_high: tuple[int, int] = (2, 5)
    n_cat_low: tuple[int, int] = (2, 5)
    bins: tuple[int, int] = (5, 10)
    max_depth: tuple[int, int] = (3, 10)
    learning_rate: tuple[float, float] = (0.001, 0.3)
    min_instances: tuple[int, int] = (1, 10)
    subsample: tuple[float, float] = (0.5, 1.0)
    feature_share: tuple[float, float] = (0.5, 1.0)


@dataclass(frozen=True)
class Settings:
    seed: int = SEED
    selection: SelectionLists = field(default_factory=SelectionLists)
    engineering: EngineeringLists = field(default_factory=EngineeringLists)
    engineering_params: EngineeringParams = field(default_factory=EngineeringParams)
    boosting: BoostingParams = field(default_factory=BoostingParams)
