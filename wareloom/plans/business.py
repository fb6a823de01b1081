"""Business questions over listing rows and entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareloom.functions.columns import log_amount
from wareloom.operators.counts import top_rows, weekday_counts, weekday_hours
from wareloom.operators.entity import entity_aggregate
from wareloom.operators.profile import density

# Entity levels and their key.
LEVELS = {"product": "product_id", "seller": "seller_id", "site": "site_id"}


def condition_shares(rows: DataFrame) -> DataFrame:
    """(level, condition, n, share): entities per condition at each level, from one count of all levels."""
    keys = F.array(
        *[F.struct(F.lit(level).alias("level"), F.col(key).cast("string").alias("key")) for level, key in LEVELS.items()]
    )
    counted = rows.select("target", F.inline(keys)).groupBy("level", "key", "target").agg(F.count("*").alias("n"))
    rank = F.struct(-F.col("n"), F.col("target").isNull(), F.col("target"))
    entities = counted.groupBy("level", "key").agg(F.min_by("target", rank).alias("condition"))
    counts = entities.where("condition is not null").groupBy("level", "condition").agg(F.count("*").alias("n"))
    # One row per level and condition.
    total = F.sum("n").over(Window.partitionBy("level"))
    return counts.select("level", "condition", "n", (F.col("n") / total).alias("share"))


def product_amounts(rows: DataFrame) -> DataFrame:
    """(product_id, condition, total_amount, log_amount)."""
    products = entity_aggregate(rows, "product_id", modes=["condition"], ordered=False)
    return products.select(
        "product_id", "condition", "total_amount", log_amount(F.col("total_amount")).alias("log_amount")
    )


def amount_density(rows: DataFrame, points: int = 200) -> DataFrame:
    """Density of the logarithmic amount per condition."""
    counts = (
        product_amounts(rows)
        .where(F.col("log_amount").isNotNull() & F.col("condition").isNotNull())
        .groupBy("condition", F.col("log_amount").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return density(counts, ["condition"], points)


def new_products(rows: DataFrame) -> DataFrame:
    products = entity_aggregate(rows, "product_id", modes=["condition"], keep_helpers=True, ordered=False)
    return products.where("condition = 'new'")


def new_by_weekday(rows: DataFrame) -> DataFrame:
    return weekday_counts(new_products(rows))


def new_by_weekday_hour(rows: DataFrame) -> DataFrame:
    return weekday_hours(new_products(rows))


def top_revenue(rows: DataFrame, n: int = 10) -> DataFrame:
    products = entity_aggregate(rows, "product_id", modes=["title"], ordered=False)
    return top_rows(products, "total_amount", "product_id", n).select("product_id", "title", "total_amount")
