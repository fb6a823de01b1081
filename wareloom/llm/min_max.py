"""Near-duplicates by min-max hashing.

A document's set holds its distinct four-word shingles. Under each permutation of
the shingle hashes both the minimum and the maximum are kept, so half as many
permutations give as many signature values; two permutations make a band of four
values. Documents that share a band are candidates, and candidates are linked only
if their full sets overlap enough.

Equal sets are one class first, so copies cost one row each. Within a bucket
candidates are not paired with each other: the member that shares most bands with
others is the hub and is compared with the rest. Members of buckets that then still
hold several components are candidates of each other only if they could be linked:
shingles are ordered from the rarest on, two sets that overlap enough have a common
one among the first fifth of each, and its places bound the overlap. Nothing that can
be linked is left out by that. Shingles that only one component has in front make no
candidates, and the component that most sets with a shingle in front belong to is
compared with the others, not with itself. Components come from edge contraction.

Null and empty texts have an empty set and stay alone. Texts shorter than a
shingle have their whole word sequence as one. Rows without doc_id stay alone and
are kept. Rows that share a doc_id are judged each by its own text. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.llm.common import materialize
from wareloom.llm.tokens import lowered_words, text_batches

SHINGLE_WORDS = 4
THRESHOLD = 80  # hundredths
BANDS = 20
PERMUTATIONS_PER_BAND = 2

_RNG = np.random.default_rng(20240229)
FLIPS = _RNG.integers(0, 2**64, BANDS * PERMUTATIONS_PER_BAND, dtype=np.uint64)
FACTORS = _RNG.integers(0, 2**64, BANDS * PERMUTATIONS_PER_BAND, dtype=np.uint64) | np.uint64(1)
#: Longer shingles draw more, the first stay the same.
PLACES = _RNG.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, length: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    code, at, distinct = lowered_words(texts)
    word = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()], np.uint64)[code]
    out = []
    with np.errstate(over="ignore"):
        m = max(0, len(word) - length + 1)
        rolled = np.zeros(m, np.uint64)
        for k in range(length):
            rolled += mixed(word[k : k + m] + np.uint64(k)) * PLACES[k]
        rolled = mixed(rolled)
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= length:
                out.append(np.unique(rolled[a : b - length + 1]))
            elif b > a:
                short = word[a:b] * PLACES[: b - a]
                out.append(mixed(np.array([short.sum() + np.uint64(b - a) * MIX], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One key per non-empty set and band from the minima and maxima of the band's permutations."""
    keys = np.zeros((len(sets), BANDS), np.uint64)
    if not sets:
        return keys
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(sets), np.uint64(band + 1) * MIX)
            for k in range(band * PERMUTATIONS_PER_BAND, (band + 1) * PERMUTATIONS_PER_BAND):
                order = (flat ^ FLIPS[k]) * FACTORS[k]
                key = mixed(key * PLACES[0] + mixed(np.minimum.reduceat(order, starts)))
                key = mixed(key * PLACES[1] + mixed(np.maximum.reduceat(order, starts)))
            keys[:, band] = key
    return keys


def sign(docs: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_id, n_shingles, set_id, bands`` of every row."""
    columns = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("text_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, 1):
                sets = shingle_sets(batch.column(1), length)
                filled = [s for s in sets if len(s)]
                keys = iter(band_keys(filled).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_id", "n_shingles", "set_id", "bands"],
                )

    id_type = dict(columns.dtypes)["doc_id"]
    return columns.mapInArrow(run, f"doc_id {id_type}, text_id string, n_shingles long, set_id binary, bands array<long>")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row per distinct set: ``set_id, rep, n_shingles, bands, copies``; rep is the smallest doc_id."""
    rows = signed.where("set_id is not null and doc_id is not null")
    return rows.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("first"), F.count("*").alias("copies")
    ).select("set_id", F.col("first.doc_id").alias("rep"), "first.n_shingles", "first.bands", "copies")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``bucket, set_id, rep, n_shingles, size, weight`` of classes that share a bucket.

    ``weight`` is the number of neighbours over all bands of a class: the text that
    others were derived from has more than its derivatives.
    """
    rows = classes.select("set_id", "rep", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(rows.join(sizes, "bucket"), "buckets")
    weights = shared.groupBy("set_id").agg(F.sum("size").alias("weight"))
    return materialize(shared.join(weights, "set_id"), "buckets")


def hub_pairs(shared: DataFrame) -> DataFrame:
    """Each member with the hub of its bucket: ``a, b`` (a < b) whose sizes allow a link."""
    hubs = (
        shared.groupBy("bucket")
        .agg(F.max(F.struct("weight", "set_id", "n_shingles")).alias("hub"))
        .select("bucket", F.col("hub.set_id").alias("hub"), F.col("hub.n_shingles").alias("hub_n"))
    )
    small, large = F.least("n_shingles", "hub_n"), F.greatest("n_shingles", "hub_n")
    return (
        shared.join(hubs, "bucket")
        .where((F.col("set_id") != F.col("hub")) & (100 * small >= THRESHOLD * large))
        .select(F.least("set_id", "hub").alias("a"), F.greatest("set_id", "hub").alias("b"))
        .distinct()
    )


def front_shingles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, label, n, shingle, place`` of the shingles in front that members share; ``members`` have ``id, set_id, label``.

    Shingles are ordered by the number of members that have them, then by hash. A set
    of n can overlap another one enough only if they share one of its first
    n - ceil(0.8 n) + 1. Shingles of one member come first and are counted, not listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column(1)]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in lists])
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(flat)], ["id", "shingle"])

    every = members.join(sets, "set_id").select("id", "shingles").mapInArrow(run, "id long, shingle long")
    spread = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    ordered = every.join(spread, "shingle").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("members", "shingle"))).alias("order"))
    n, own = F.col("n_shingles"), F.col("n_shingles") - F.size("order")
    reach = F.greatest(F.lit(0), n - F.ceil(n * THRESHOLD / 100) + 1 - own).cast("int")
    front = ordered.join(members, "id").select("id", "label", n.alias("n"), own.alias("own"), F.slice("order", F.lit(1), reach).alias("front"))
    return front.select("id", "label", "n", "own", F.posexplode("front").alias("at", "one")).select(
        "id", "label", "n", F.col("one.shingle").alias("shingle"), (F.col("own") + F.col("at") + 1).alias("place")
    )


def front_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` (a < b) of members of different components that may overlap enough."""
    front = materialize(front_shingles(members, sets), "fronts")
    labels = front.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("rows"))
    shared = labels.groupBy("shingle").agg(F.max_by("label", F.struct("rows", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    front = front.join(shared.where("labels > 1").select("shingle", "main"), "shingle")
    x = front.where("label != main").select("shingle", *[F.col(c).alias(f"x_{c}") for c in ("id", "label", "n", "place")])
    y = front.select("shingle", (F.col("label") == F.col("main")).alias("y_main"), *[F.col(c).alias(f"y_{c}") for c in ("id", "label", "n", "place")])
    # What two sets can have in common at most, if this is the first shingle that they share.
    most = 1 + F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    enough = (100 + THRESHOLD) * most >= THRESHOLD * (F.col("x_n") + F.col("y_n"))
    once = F.col("y_main") | (F.col("x_id") < F.col("y_id"))
    pairs = x.join(y, "shingle").where((F.col("x_label") != F.col("y_label")) & enough & once)
    pairs = pairs.select(F.least("x_id", "y_id").alias("u"), F.greatest("x_id", "y_id").alias("v")).distinct()
    one, two = (members.select(F.col("id").alias(i), F.col("set_id").alias(name)) for i, name in (("u", "one"), ("v", "two")))
    return pairs.join(one, "u").join(two, "v").select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))


def full_sets(docs: DataFrame, wanted: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``set_id, shingles`` of the wanted classes (``set_id, rep``), read again from the documents' texts."""
    texts = docs.select("doc_id", "text").join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("set_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, 1):
                sets = shingle_sets(batch.column(1), length)
                # Rows that share a doc_id may hold other texts.
                own = [i for i, s in enumerate(sets) if set_digest(s) == batch.column(0)[i].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own, pa.int64())), pa.array([sets[i].tobytes() for i in own], pa.binary())],
                    ["set_id", "shingles"],
                )

    return texts.mapInArrow(run, "set_id binary, shingles binary").dropDuplicates(["set_id"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets overlap enough."""
    one = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                left = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
                right = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * common >= THRESHOLD * (len(left) + len(right) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(run, "a binary, b binary")


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each component, for nodes whose label is another one.

    Every round each component hooks onto its smallest neighbour, chains of hooks
    are shortened by pointer jumping, and the edges are rewritten between what is
    left, so a long chain takes as many rounds as its length has binary digits.
    """
    both = edges.select("u", "v").where("u != v")
    labels = None
    while True:
        both = materialize(both.union(both.select("v", "u")).distinct(), "edges")
        if both.isEmpty():
            break
        hooks = materialize(both.groupBy("u").agg(F.min("v").alias("to")).where("`to` < u"), "hooks")
        while True:
            jumped = hooks.alias("x").join(hooks.alias("y"), F.col("x.to") == F.col("y.u"), "left")
            after = materialize(
                jumped.select(F.col("x.u").alias("u"), F.coalesce("y.to", "x.to").alias("to"), F.col("y.to").isNotNull().alias("moved")),
                "hooks",
            )
            hooks = after.select("u", "to")
            if after.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks.select(F.col("u").alias("node"), F.col("to").alias("label"))
        else:
            moved = labels.join(hooks, F.col("label") == F.col("u"), "left").select("node", F.coalesce("to", "label").alias("label"))
            fresh = hooks.join(labels.select(F.col("node").alias("u")), "u", "left_anti").select(F.col("u").alias("node"), F.col("to").alias("label"))
            labels = materialize(moved.unionByName(fresh), "labels")
        renamed = both
        for side in ("u", "v"):
            to = hooks.select(F.col("u").alias("_from"), F.col("to").alias("_to"))
            renamed = renamed.join(to, F.col(side) == F.col("_from"), "left").withColumn(side, F.coalesce("_to", side)).drop("_from", "_to")
        both = renamed.where("u != v")
    spark = edges.sparkSession
    kind = edges.schema["u"].dataType
    empty = spark.createDataFrame([], T.StructType([T.StructField("node", kind), T.StructField("label", kind)]))
    return empty if labels is None else labels


def link(docs: DataFrame, signed: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``set_id, component, first_set`` of every class that has copies or links: the component's smallest rep and its set.

    Components join sets, not reps: rows that share a doc_id can hold unrelated texts.
    """
    classes = materialize(classes_of(signed), "classes")
    shared = shared_buckets(classes)
    sets = materialize(full_sets(docs, shared.select("set_id", "rep").distinct(), length), "sets")
    reps = shared.select("set_id", "rep").distinct()

    def components(links: DataFrame) -> DataFrame:
        a, b = (reps.select(F.col("set_id").alias(c), F.struct("rep", "set_id").alias(r)) for c, r in (("a", "u"), ("b", "v")))
        found = connected(links.join(a, "a").join(b, "b").select("u", "v"))
        found = found.select(F.col("node.set_id").alias("node"), F.col("label.rep").alias("component"), F.col("label.set_id").alias("first_set"))
        return materialize(found, "components")

    links = materialize(confirm(materialize(hub_pairs(shared), "pairs"), sets), "links")
    labels = components(links)

    # A bucket of two is done after its hub; others are open as long as components differ.
    placed = shared.where("size > 2").join(labels, F.col("set_id") == F.col("node"), "left")
    placed = placed.select("bucket", "set_id", "n_shingles", F.hex(F.coalesce("first_set", "set_id")).alias("label"))
    open_buckets = placed.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("bucket")
    members = placed.join(open_buckets, "bucket").select("set_id", "n_shingles", "label").distinct()
    members = materialize(members.withColumn("id", F.monotonically_increasing_id()), "members")
    if not members.isEmpty():
        found = materialize(confirm(materialize(front_pairs(members, sets), "pairs"), sets), "links")
        if not found.isEmpty():
            labels = components(links.unionByName(found))
    named = classes.join(labels, F.col("set_id") == F.col("node"), "left").where("copies > 1 or component is not null")
    return named.select("set_id", F.coalesce("component", "rep").alias("component"), F.coalesce("first_set", "set_id").alias("first_set"))


def judged(docs: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_id, n_shingles, set_id, component_id, first_set`` for every row; first_set is null where it is the row's own."""
    signed = materialize(sign(docs, length), "signatures")
    linked = link(docs, signed.select("doc_id", "n_shingles", "set_id", "bands"), length)
    rows = signed.select("doc_id", "text_id", "n_shingles", "set_id").join(linked, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "text_id", "n_shingles", "set_id", component.alias("component_id"), "first_set")


def near_duplicates(docs: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return judged(docs, length).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def kept_texts(docs: DataFrame, length: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_id`` (md5 of the text) of what stays: one text per doc_id and set that the component is named after.

    Of several texts with one set, the smallest text_id. Rows without doc_id are left out.
    """
    first = (F.col("doc_id") == F.col("component_id")) & F.coalesce(F.col("first_set") == F.col("set_id"), F.lit(True))
    return judged(docs, length).where(first).groupBy("doc_id", "set_id").agg(F.min("text_id").alias("text_id")).drop("set_id")
