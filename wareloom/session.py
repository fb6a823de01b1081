"""Session defaults for running the package outside a managed cluster."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings the plans are written for. Shuffle partition counts and
# memory belong to the cluster and are left to it.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the aggregate above needs one more
    # shuffle: cheaper than a single task holding a third of the table.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cleaning projects dozens of text columns at once. A generated method above
    # 8000 bytes is never compiled by HotSpot, so let such a projection be split.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Look null tokens up in a set instead of comparing one by one.
    "spark.sql.optimizer.inSetConversionThreshold": "4",
}


def build_session(
    app: str = "wareloom", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it is not installed but lies at the same place."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        env["PYTHONPATH"] = ":".join([*known, root])
    return spark
