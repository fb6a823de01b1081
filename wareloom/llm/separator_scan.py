"""Token counts of documents in flat token files without an index.

A token file is nothing but fixed-width ids, every document closed by an
end-of-document id. Files are cut into blocks at fixed offsets, so documents
reach over block ends. Tasks read byte ranges, so a file may be of any size. A block is searched for the end id with one vectorised
comparison and leaves only its length and the places found. Prefix sums over the
blocks of a file, in two levels, tell each block where it begins and where its
first document began in an earlier block.

An empty document has 0 tokens. A file's rest after the last end id is one
unclosed document. Null texts count as empty; repeated rows and ids are separate
documents; empty tables give no blocks and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wareloom.llm.common import materialize, new_path
from wareloom.llm.tokens import text_batches, word_tokenizer

BLOCK_TOKENS = 1 << 16
BLOCKS_PER_GROUP = 1024
#: Neighbouring blocks that one task reads, and what a task reads in all.
RUN_BYTES, TASK_BYTES = 8 << 20, 64 << 20
WIDTHS = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@%"))


def write_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, width: int = 2) -> DataFrame:
    """Flat token files of documents, one per input partition, and a table ``file, ordinal, doc_id`` of their order.

    ``folder`` must be one that all executors reach. Every attempt of a task writes
    a file of its own name; the table is written after it and holds the names of
    successful attempts only, so files of lost attempts are never counted. It holds
    no places or lengths.
    """
    kind = WIDTHS[width]
    columns = docs.select("doc_id", "text")
    id_type = dict(columns.dtypes)["doc_id"]
    where, root = file_system(folder)
    where.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = word_tokenizer(tokenizer), TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        out, ordinal = None, 0
        for whole in batches:
            for batch in text_batches(whole, 1, 3_000_000):
                if out is None:
                    where, root = file_system(folder)
                    out = where.open_output_stream(f"{root}/{name}")
                ids, begin = encoder.encode_texts(batch.column(1))
                n = batch.num_rows
                stream = np.empty(len(ids) + n, kind)
                last = begin[1:] + np.arange(n)
                body = np.ones(len(stream), bool)
                body[last] = False
                stream[body], stream[last] = ids, end_id
                out.write(stream)
                order = np.arange(ordinal, ordinal + n)
                ordinal += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n, pa.string()), pa.array(order), batch.column(0)], ["file", "ordinal", "doc_id"]
                )
        if out is not None:
            out.close()

    return materialize(columns.mapInArrow(write, f"file string, ordinal long, doc_id {id_type}"), "file-order")


def file_blocks(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks at fixed offsets of all flat files under ``path``: ``file`` (the whole path), ``block, tokens``.

    Files are listed with their lengths and never read whole: runs of blocks of one
    file are dealt to tasks, which read their byte ranges.
    """
    size = width * block_tokens
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    last = F.floor((F.col("length") - 1) / size)
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    run = F.floor(F.col("block") * size / RUN_BYTES)
    ranges = ranges.repartition(tasks, "path", run).sortWithinPartitions("path", "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, handle = None, None
        for batch in batches:
            for path, length, block in zip(*[c.to_pylist() for c in batch.columns]):
                if path != opened:
                    if handle is not None:
                        handle.close()
                    where, inside = file_system(path)
                    opened, handle = path, where.open_input_file(inside)
                start = block * size
                part = handle.read_at(min(size, length - start), start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([part], pa.binary())],
                    ["file", "block", "tokens"],
                )
        if handle is not None:
            handle.close()

    return ranges.mapInArrow(read, "file string, block long, tokens binary")


def find_ends(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    """``file, block, n, ends``: length and places of the end id, one comparison per block."""
    kind = WIDTHS[width]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), kind) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([np.flatnonzero(x == end_id) for x in found], pa.list_(pa.int64())),
                ],
                ["file", "block", "n", "ends"],
            )

    return blocks.select("file", "block", "tokens").mapInArrow(search, "file string, block long, n long, ends array<long>")


def stitch(found: DataFrame) -> DataFrame:
    """Documents of the searched blocks: ``file, ordinal, start, n_tokens, closed``.

    ``found`` is read twice, so it should be a written table. Blocks are summed in
    groups of 1024, the groups of a file by a second scan, so no task sees more
    than a file's groups.
    """
    found = found.withColumn("grp", F.floor(F.col("block") / BLOCKS_PER_GROUP))
    n_ends = F.size("ends")
    last_end = F.when(n_ends > 0, F.element_at("ends", -1) + 1)

    inner = Window.partitionBy("file", "grp").orderBy("block")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    local = found.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "seen", F.coalesce(F.sum(n_ends).over(before), F.lit(0))
    )
    local = local.withColumn("open_at", F.max(F.col("at") + last_end).over(before))

    groups = local.groupBy("file", "grp").agg(
        F.sum("n").alias("g_n"), F.sum(n_ends).alias("g_ends"), F.max(F.col("at") + last_end).alias("g_last")
    )
    outer = Window.partitionBy("file").orderBy("grp")
    earlier = outer.rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("g_at", F.coalesce(F.sum("g_n").over(earlier), F.lit(0))).withColumn(
        "g_seen", F.coalesce(F.sum("g_ends").over(earlier), F.lit(0))
    )
    groups = groups.withColumn("g_open", F.coalesce(F.max(F.col("g_at") + F.col("g_last")).over(earlier), F.lit(0)))
    whole = groups.groupBy("file").agg(
        F.sum("g_n").alias("size"),
        F.sum("g_ends").alias("ordinal"),
        F.coalesce(F.max(F.col("g_at") + F.col("g_last")), F.lit(0)).alias("start"),
    )

    placed = local.join(groups.select("file", "grp", "g_at", "g_seen", "g_open"), ["file", "grp"]).select(
        "file",
        (F.col("g_at") + F.col("at")).alias("at"),
        (F.col("g_seen") + F.col("seen")).alias("seen"),
        F.coalesce(F.col("g_at") + F.col("open_at"), F.col("g_open")).alias("open_at"),
        "ends",
    )
    begins = F.transform(
        "ends", lambda e, i: F.when(i == 0, F.col("open_at")).otherwise(F.col("at") + F.get("ends", i - 1) + 1)
    )
    closed = placed.select(
        "file", "at", "seen", "ends", F.posexplode(begins).alias("i", "start")
    ).select(
        "file",
        (F.col("seen") + F.col("i")).alias("ordinal"),
        "start",
        (F.col("at") + F.get("ends", "i") - F.col("start")).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    rest = whole.where(F.col("size") > F.col("start")).select(
        "file",
        "ordinal",
        "start",
        (F.col("size") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(rest)


def count_tokens(blocks: DataFrame, end_id: int, width: int = 2) -> DataFrame:
    return stitch(materialize(find_ends(blocks, end_id, width), "ends"))


def count_documents(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, file, ordinal, start, n_tokens`` of documents, counted from flat files written of them."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-files")
    names = write_files(docs, tokenizer, end_id, folder, width)
    counted = count_tokens(file_blocks(spark, folder, width, block_tokens), end_id, width)
    named = counted.where("closed").withColumn("file", F.element_at(F.split("file", "/"), -1))
    return named.join(names, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
