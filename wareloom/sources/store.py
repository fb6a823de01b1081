"""Tables written to the folder all executors share.

Cutting a plan goes through a written table, so a lost executor costs a
re-read and never the result.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the caller set, else the configured one; a private one only on a local master."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="wareloom-")
    spark.sparkContext.setCheckpointDir(root)
    return shared_dir(spark)


# Paths handed out in this process, for cleanup().
_HANDED_OUT: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


def cleanup(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; frames that read them are used up then."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    deleted = 0
    while _HANDED_OUT:
        path = jvm.org.apache.hadoop.fs.Path(_HANDED_OUT.pop())
        deleted += bool(path.getFileSystem(conf).delete(path, True))
    return deleted


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and continue from the written copy."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
