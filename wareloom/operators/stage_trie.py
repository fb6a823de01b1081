"""Fitted stages shared between pipelines that begin alike.

Pipelines are paths through a trie. A node holds a fitted stage; a stage is fitted
once for all pipelines that come to it by the same fitted stages with the same
settings. Settings that lead to the same fitted values are one node, so what follows
is shared too.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame


def signature(stage) -> str:
    """Class and options of a stage; tables that a fit wrote count by their schema, sizes and values, not by their place."""
    options = stage.getOrDefault(stage.options) if stage.isSet(stage.options) else {}
    plain = {n: {k: v for k, v in o.items() if k != "path"} if n in stage.written_tables() or _frozen(o) else o for n, o in options.items()}
    elsewhere = [t["path"] for t in stage.written_tables().values()]
    return json.dumps([type(stage).__name__, plain, elsewhere], sort_keys=True, default=str)


def _frozen(option) -> bool:
    return isinstance(option, dict) and "schema" in option and "values" in option


class Node:
    """A fitted stage and the training rows after it (none at the root)."""

    def __init__(self, rows: DataFrame, stages: tuple[Transformer, ...] = ()):
        self.rows = rows
        self.stages = stages
        self.by_settings: dict[str, Node] = {}
        self.by_values: dict[str, Node] = {}


class StageTrie:
    """Fits pipelines on ``rows``; ``fits`` counts the stages that were fitted, ``asked`` those that were asked for."""

    def __init__(self, rows: DataFrame):
        self.root = Node(rows)
        self.fits = 0
        self.asked = 0

    def fit(self, stages: list[Estimator | Transformer]) -> Node:
        """The node at the end of a pipeline."""
        node = self.root
        for stage in stages:
            node = self.step(node, stage)
        return node

    def step(self, node: Node, stage: Estimator | Transformer) -> Node:
        settings = signature(stage)
        self.asked += isinstance(stage, Estimator)
        if settings not in node.by_settings:
            fitted = stage
            if isinstance(stage, Estimator):
                self.fits += 1
                fitted = stage.fit(node.rows)
            values = signature(fitted)
            if values not in node.by_values:
                node.by_values[values] = Node(fitted.transform(node.rows), (*node.stages, fitted))
            node.by_settings[settings] = node.by_values[values]
        return node.by_settings[settings]
