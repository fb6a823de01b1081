import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wareloom.llm.common import importable  # noqa: E402


@pytest.fixture(autouse=True)
def _workers_find_the_package(spark):
    importable(spark)


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def frame(spark):
    """``frame(rows)``: a documents table with odd rows and clashing extra columns if asked."""

    def make(texts, ids=None, sources=None, extra=()):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        schema = T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("text", T.StringType()),
                T.StructField("source", T.StringType()),
                *[T.StructField(name, T.StringType()) for name in extra],
            ]
        )
        rows = [(i, t, s, *["x"] * len(extra)) for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, schema)

    return make
