"""Shards of near equal bytes by histogram sort.

Rows have an order (a list of whole-number keys, compared from the first on). The
cuts between shards are found by counting: every pass sums the bytes of all rows
between probes, which part the stretch that still holds a wanted cut into up to
``PROBES`` pieces, and goes on with the piece that the wanted byte lies in. The sums
are exact, so is what lies below each probe. Stretches shrink to the keys met in
them, so sparse keys cost no further passes. When the cuts stand, a row's shard is an
expression, and rows are exchanged once, by shard and key.

A cut goes to the nearest boundary between two values of the first key if that
meets the tolerance (a share of a shard's mean bytes), else to the nearest boundary
between two rows. With a digest of the text as the first key, copies of a text lie
side by side and stay in one shard unless that would unbalance the shards; a text
that holds a third of all rows is spread over as many shards as its bytes fill. The
result does not depend on the probes or on how the table is partitioned.

Texts that are null have no bytes and count as empty, so they lie beside empty ones.
A null doc_id comes after the others. Rows that are equal in all keys are told apart
by a number given when the keys are written; which of them gets which slot is open,
the rows are the same. More shards than rows leave shards empty; an empty table
gives no rows. Ids span less than 2^63. Other columns go along; columns already
named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.llm.common import free_names, materialize, placed

PROBES = 1024
#: Share of a shard's mean bytes that a cut between two texts may be off.
TOLERANCE_PARTS = 1000
DIGEST_DIGITS = 15
ROW_BYTES = 8


@dataclass
class Stretch:
    """Rows whose keys begin with ``fixed`` and whose next one is from ``low`` to ``high``; ``below`` bytes come before."""

    fixed: tuple[int, ...]
    low: int
    high: int
    below: int
    wanted: list[int] = field(default_factory=list)


@dataclass(frozen=True)
class Cut:
    """Rows from ``key`` on, or ``after`` it, lie behind the cut; ``key`` may name the first keys only."""

    key: tuple[int, ...]
    after: bool


def is_behind(cut: Cut, keys: list[str]) -> Column:
    """Whether a row lies behind a cut."""
    behind = F.lit(not cut.after)
    for name, value in reversed(list(zip(keys, cut.key))):
        behind = (F.col(name) > value) | ((F.col(name) == value) & behind)
    return behind


def within(stretch: Stretch, keys: list[str]) -> Column:
    inside = F.col(keys[len(stretch.fixed)]).between(stretch.low, stretch.high)
    for name, value in zip(keys, stretch.fixed):
        inside = (F.col(name) == value) & inside
    return inside


def count_between_probes(rows: DataFrame, size: str, keys: list[str], stretches: list[Stretch]) -> list[list]:
    """Per stretch its filled pieces in order: bytes, least and greatest key, and those of the next key."""
    chosen = {"stretch": None, "piece": None, "key": None, "next": None}
    for number, s in enumerate(stretches):
        depth = len(s.fixed)
        width = max(1, -(-(s.high - s.low + 1) // PROBES))
        key = F.col(keys[depth])
        values = {
            "stretch": F.lit(number),
            "piece": F.floor((key - s.low) / width),
            "key": key,
            "next": F.col(keys[depth + 1]) if depth + 1 < len(keys) else F.lit(None).cast("long"),
        }
        inside = within(s, keys)
        for name, value in values.items():
            chosen[name] = F.when(inside, value) if chosen[name] is None else chosen[name].when(inside, value)
    found = rows.select(*[c.alias(n) for n, c in chosen.items()], F.col(size).alias("bytes")).where("stretch is not null")
    sums = found.groupBy("stretch", "piece").agg(
        F.sum("bytes").alias("bytes"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.min("next").alias("next_low"),
        F.max("next").alias("next_high"),
    )
    # At most PROBES rows for each cut that is still open.
    pieces: list[list] = [[] for _ in stretches]
    for row in sums.collect():
        pieces[row["stretch"]].append(row)
    return [sorted(p, key=lambda r: r["piece"]) for p in pieces]


def find_cuts(rows: DataFrame, size: str, keys: list[str], shards: int, tolerance_parts: int = TOLERANCE_PARTS) -> list[Cut]:
    """The cuts between ``shards`` shards, fewer than ``shards - 1`` for an empty table."""
    whole = rows.agg(F.sum(size).alias("bytes"), F.min(keys[0]).alias("low"), F.max(keys[0]).alias("high")).first()
    total = whole["bytes"]
    if not total or shards < 2:
        return []
    targets = {i: total * i // shards for i in range(1, shards)}
    tolerance = total // (shards * tolerance_parts)
    cuts: dict[int, Cut] = {}
    stretches = [Stretch((), whole["low"], whole["high"], 0, list(targets))]
    while stretches:
        refined: dict[tuple, Stretch] = {}
        for s, pieces in zip(stretches, count_between_probes(rows, size, keys, stretches)):
            depth = len(s.fixed)
            for i in s.wanted:
                below = s.below
                for piece in pieces:
                    if targets[i] < below + piece["bytes"]:
                        break
                    below += piece["bytes"]
                if piece["low"] < piece["high"]:
                    narrower = Stretch(s.fixed, piece["low"], piece["high"], below)
                else:
                    left, right = targets[i] - below, below + piece["bytes"] - targets[i]
                    key = (*s.fixed, piece["low"])
                    last = depth + 1 == len(keys)
                    if last or (depth == 0 and min(left, right) <= tolerance):
                        cuts[i] = Cut(key, right < left)
                        continue
                    narrower = Stretch(key, piece["next_low"], piece["next_high"], below)
                refined.setdefault((narrower.fixed, narrower.low), narrower).wanted.append(i)
        stretches = list(refined.values())
    return [cuts[i] for i in sorted(cuts)]


def shard_rows(
    rows: DataFrame, size: Column, order: list[Column], shards: int, tolerance_parts: int = TOLERANCE_PARTS
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0, in the order of the keys), cut where bytes are equal.

    ``order`` are whole-number columns without nulls. The columns of ``rows`` are
    written once and exchanged once; pass only those that should go along.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    bytes_, own, *keys = free_names(rows, "_bytes", "_own", *[f"_key{k}" for k in range(len(order))])
    keys = [*keys, own]
    named = {bytes_: size.cast("long"), **{k: c.cast("long") for k, c in zip(keys, order)}, own: F.monotonically_increasing_id()}
    keyed = materialize(rows.select(*kept, *[c.alias(n) for n, c in named.items()]), "keys")
    cuts = find_cuts(keyed, bytes_, keys, shards, tolerance_parts)
    shard = sum((is_behind(cut, keys).cast("int") for cut in cuts), F.lit(0))
    return placed(keyed.withColumn("shard", shard), ["shard"], keys, "slot").select(*kept, "shard", "slot")


def document_order(text: str = "text", doc_id: str = "doc_id") -> list[Column]:
    """Digest of the text (60 bits), then doc_id, null last."""
    digest = F.substring(F.md5(F.coalesce(F.col(text), F.lit(""))), 1, DIGEST_DIGITS)
    return [F.conv(digest, 16, 10).cast("long"), F.col(doc_id).isNull().cast("long"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0))]


def document_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shard_documents(docs: DataFrame, shards: int, tolerance_parts: int = TOLERANCE_PARTS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document."""
    text_crc32 = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    order = document_order()
    size, crc, *keys = free_names(docs, "_size", "_crc", *[f"_order{k}" for k in range(len(order))])
    # Texts are read here and stay behind.
    narrow = docs.select("doc_id", document_bytes().alias(size), text_crc32.alias(crc), *[c.alias(k) for c, k in zip(order, keys)])
    placed_rows = shard_rows(narrow, F.col(size), [F.col(k) for k in keys], shards, tolerance_parts)
    return placed_rows.select(
        "doc_id",
        F.col(size).alias("size"),
        F.col(crc).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, each file in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def oracle(shards: int, tolerance_parts: int = TOLERANCE_PARTS) -> str:
    """The same shards and slots in SQL."""
    return f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)),
         lambda c, step: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS entry
  FROM range(256) r(n)
), keyed AS (
  SELECT doc_id, coalesce(strlen(text), 0) + {ROW_BYTES} AS size,
         ('0x' || substr(md5(coalesce(text, '')), 1, {DIGEST_DIGITS}))::BIGINT AS k,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda b: ('0x' || b)::BIGINT)),
             lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc_table
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY k, doc_id IS NULL, doc_id ROWS UNBOUNDED PRECEDING) - size AS below,
         sum(size) OVER (ORDER BY k) AS group_end, sum(size) OVER (PARTITION BY k) AS group_size
  FROM keyed
), wanted AS (
  SELECT i, total * i // {shards} AS target, total // ({shards} * {tolerance_parts}) AS tolerance
  FROM (SELECT sum(size) AS total FROM keyed), range(1, {shards}) r(i)
), near AS (
  SELECT i, target, tolerance,
         CASE WHEN group_end - target < target - (group_end - group_size) THEN group_end ELSE group_end - group_size END AS by_text,
         CASE WHEN below + size - target < target - below THEN below + size ELSE below END AS by_row
  FROM wanted JOIN placed ON target >= below AND target < below + size
), cuts AS (
  SELECT CASE WHEN abs(by_text - target) <= tolerance THEN by_text ELSE by_row END AS cut FROM near
), sharded AS (
  SELECT doc_id, size, k, crc, (SELECT count(*) FROM cuts WHERE cut <= below) AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY k, doc_id IS NULL, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM sharded
"""
