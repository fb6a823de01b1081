import hashlib
import zlib
from collections import Counter

import pytest
from conftest_llm import ODD_TEXTS
from pyspark.sql import functions as F

from wareloom.llm import histogram_shards as hs


def by_hand(rows, shards, tolerance_parts=hs.TOLERANCE_PARTS):
    """(doc_id, text) rows in key order with shard and slot, from running totals over the sorted list."""

    def key(row):
        digest = int(hashlib.md5((row[1] or "").encode()).hexdigest()[: hs.DIGEST_DIGITS], 16)
        return digest, row[0] is None, row[0] or 0

    rows = sorted(rows, key=key)
    sizes = [len((text or "").encode()) + 8 for _, text in rows]
    total = sum(sizes)
    ends, at = [], 0
    for size in sizes:
        at += size
        ends.append(at)
    edges = [0, *ends]
    by_text = [0, *[e for e, row, nxt in zip(ends, rows, [*rows[1:], None]) if nxt is None or key(row)[0] != key(nxt)[0]]]

    def nearest(places, target):
        return min(places, key=lambda e: (abs(e - target), e))

    cuts = []
    for i in range(1, shards):
        target = total * i // shards
        whole = nearest(by_text, target)
        cuts.append(whole if abs(whole - target) <= total // (shards * tolerance_parts) else nearest(edges, target))
    out, slots = [], Counter()
    for row, start in zip(rows, edges):
        shard = sum(c <= start for c in cuts)
        out.append((row[0], row[1], shard, slots[shard]))
        slots[shard] += 1
    return out


def result(df):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()), key=repr)


def wanted(rows, shards, tolerance_parts=hs.TOLERANCE_PARTS):
    return sorted(
        (
            (doc_id, len((text or "").encode()) + 8, zlib.crc32((text or "").encode()), shard, slot)
            for doc_id, text, shard, slot in by_hand(rows, shards, tolerance_parts)
        ),
        key=repr,
    )


@pytest.mark.parametrize("shards", [1, 2, 24, 60])
def test_odd_rows_as_by_hand(frame, shards):
    texts = [*ODD_TEXTS, *[f"text {i % 17} " * (i % 9 + 1) for i in range(150)]]
    docs = frame(texts, extra=("shard", "slot", "size", "law", "_key0", "_part"))
    assert result(hs.shard_documents(docs, shards)) == wanted(list(enumerate(texts)), shards)


def test_a_third_of_all_rows_with_one_text_is_spread_and_shards_stay_equal(frame):
    texts = ["the same text in many rows"] * 400 + [f"another text, number {i}" for i in range(800)]
    sharded = hs.shard_documents(frame(texts), 8)
    assert result(sharded) == wanted(list(enumerate(texts)), 8)
    sums = [r["bytes"] for r in sharded.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * 40


def test_copies_stay_together_within_the_tolerance(frame):
    texts = [f"text {i // 5} with four copies" for i in range(1000)]
    sharded = hs.shard_documents(frame(texts), 4, tolerance_parts=20)
    assert result(sharded) == wanted(list(enumerate(texts)), 4, 20)
    rows = {r.doc_id: r.shard for r in sharded.collect()}
    assert all(len({rows[i + k] for k in range(5)}) == 1 for i in range(0, 1000, 5))


def test_repeated_rows_and_null_ids_are_cut_too(frame):
    texts, ids = ["one text"] * 100, [7] * 60 + [None] * 40
    sharded = hs.shard_documents(frame(texts, ids), 5)
    assert Counter(r.shard for r in sharded.collect()) == {k: 20 for k in range(5)}
    assert all(r.doc_id is None for r in sharded.where("shard >= 3").collect())


def test_partitioning_and_probes_change_nothing(frame, monkeypatch):
    texts = [f"{i % 90} words " * (1 + i * i % 13) for i in range(300)]
    docs = frame(texts)
    first = result(hs.shard_documents(docs.repartition(7), 6))
    monkeypatch.setattr(hs, "PROBES", 3)
    assert result(hs.shard_documents(docs.coalesce(1), 6)) == first


def test_any_rows_by_any_order(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000 - 500).alias("at"), F.lit("x").alias("slot"), F.lit(1).alias("_own"))
    sharded = hs.shard_rows(rows, F.lit(3), [F.col("at")], 4)
    assert sharded.columns == ["at", "_own", "shard", "slot"]
    for r in sharded.collect():
        assert (r.shard, r.slot) == divmod(r["at"] + 500, 250)


def test_shards_are_written_in_slot_order(frame, spark, tmp_path):
    docs = frame([f"text {i}" for i in range(50)])
    hs.write_shards(hs.shard_documents(docs, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def test_empty_table(frame):
    assert hs.shard_documents(frame([]), 24).collect() == []
