"""Base classes of pipeline stages.

A stage keeps its settings and fitted decisions as plain values, so a fitted
pipeline saves and loads with them. Subclass :class:`Step` for a row-wise
stage and :class:`Decision` for one that reads the data before it can act.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame


class _StageWriter(DefaultParamsWriter):
    """Saves the fitted tables of a stage below the stage's own path."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for name, frozen in self.instance.written_tables().items():
            self.sparkSession.read.parquet(frozen["path"]).write.parquet(f"{path}/tables/{name}")


class _StageReader(DefaultParamsReader):
    def load(self, path: str):
        stage = super().load(path)
        moved = {n: {**t, "path": f"{path}/tables/{n}"} for n, t in stage.written_tables().items()}
        stage._set(options={**stage.getOrDefault(stage.options), **moved})
        return stage


class _Options(Params, DefaultParamsReadable, DefaultParamsWritable):
    options = Param(Params._dummy(), "options", "settings and fitted decisions as plain values")

    def __init__(self, **options):
        super().__init__()
        self._set(options=options)

    def option(self, name: str, default=None):
        return self.getOrDefault(self.options).get(name, default)

    def written_tables(self) -> dict[str, dict]:
        """Options that point to a written table of fitted rows."""
        options = self.getOrDefault(self.options) if self.isSet(self.options) else {}
        return {n: v for n, v in options.items() if isinstance(v, dict) and "schema" in v and v.get("path")}

    def write(self) -> _StageWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> _StageReader:
        return _StageReader(cls)


class Step(_Options, Transformer):
    """A stage whose ``transform`` runs no job, unless it is ``batch_only``.

    ``batch_only`` marks stages that need the whole table (distinct, grouping).
    """

    batch_only = False

    def _transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


class Decision(_Options, Estimator):
    """A stage that inspects the data once and freezes what it found."""

    def _fit(self, df: DataFrame) -> Step:
        raise NotImplementedError


def require_columns(df: DataFrame, names) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def require_unique(names) -> None:
    names = list(names)
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"column names occur twice: {twice}")
