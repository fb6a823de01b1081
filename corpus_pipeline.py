"""From raw documents to packed training sequences, five stages in a row.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows that
the stage before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wareloom.llm import min_max, mixing, packing, quality_rules, sanitise
from wareloom.llm.common import free_names, importable, materialize, read_table

#: No SQL states the links, the mixture or the packing; tests compare the stages with brute force.
ORACLE_SQL = None

SHINGLE_WORDS = 5


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_rules.passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id. Rows that share a doc_id stay or go by their own text.

    Texts are alike by shingles of five words. Of rows with equal doc_id and set the
    smallest text digest stays, then the smallest digest of the other columns.
    """
    importable(spark)
    text_id, place = free_names(docs, "text_id", "place")
    kept = min_max.kept_texts(docs, SHINGLE_WORDS).toDF("doc_id", text_id)
    named = docs.withColumn(text_id, F.md5(F.coalesce("text", F.lit("")))).join(kept, ["doc_id", text_id], "left_semi")
    # Columns of any type have a text form, maps too.
    others = F.to_json(F.struct(F.lit(0).alias(place), *[c for c in docs.columns if c not in ("doc_id", "text")]))
    order = Window.partitionBy("doc_id", text_id).orderBy(F.md5(others))
    named = named.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms masked in every text."""
    clean = sanitise.sanitise(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for every time that the mixture reads them, each at least once."""
    return mixing.mix_sources(docs).select(*docs.columns)


def pack_into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    importable(spark)
    payload = F.crc32("ids").alias("ids_crc32")
    return packing.pack_documents(docs, packing.vocabulary_path(), payload=payload)


STAGES = [
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_to_weights),
    ("packing", pack_into_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
