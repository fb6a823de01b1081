"""Best-fit packing of documents into token sequences by bin completion.

A document is its token ids and an end id. Longer ones than a sequence are cut,
the others stay whole. How many pieces have each length is all the search needs,
and that table has no more rows than a sequence has tokens. The search takes the
largest piece left, enumerates undominated fillings of the room around it, drops
branches whose waste leaves no chance to beat the incumbent and starts from
best-fit solutions. A filling is used as often as the counts allow. Pieces then
find their sequence by their rank among pieces of the same length.

Null texts count as empty: one piece that holds the end id. Pieces of equal length
are ranked by a hash of doc_id, then doc_id and piece, so ties and repeated rows
are packed like any others. An empty table gives no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wareloom.llm.common import free_names, materialize
from wareloom.llm.tokens import text_batches, word_tokenizer

CAPACITY = 4096
END_ID = 1
#: Fillings tried in one search; a bound on effort, every piece is packed whatever it is.
EFFORT = 10_000
#: Steps looked ahead while completing one sequence; None enumerates all its fillings.
LOOK: int | None = 16
#: Bytes of text that are encoded at a time; token arrays take many times that.
SLICE_BYTES = 3_000_000

VOCABULARY = "word_bpe_49k.json"

Filling = tuple[tuple[int, int], ...]  # (length, how often), largest first
Pattern = tuple[Filling, int]  # a filling and the number of sequences it is used for


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Stock:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {size: n for size, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def change(self, filling: Filling, copies: int) -> None:
        for size, n in filling:
            left = self.counts.get(size, 0) + n * copies
            if left:
                if size not in self.counts:
                    insort(self.sizes, size)
                self.counts[size] = left
            else:
                del self.counts[size]
                del self.sizes[bisect_left(self.sizes, size)]

    def copies(self, filling: Filling) -> int:
        return min(self.counts[size] // n for size, n in filling)

    def left(self, size: int, used: dict[int, int]) -> int:
        return self.counts.get(size, 0) - used.get(size, 0)


def as_filling(used: dict[int, int]) -> Filling:
    return tuple(sorted(((size, n) for size, n in used.items() if n), reverse=True))


def best_fit(stock: Stock, capacity: int) -> Filling:
    """The largest piece, then always the largest that still fits."""
    used: dict[int, int] = {}
    room, at = capacity, len(stock.sizes) - 1
    while at >= 0:
        size = stock.sizes[at]
        n = min(room // size, stock.left(size, used))
        if n:
            used[size] = n
            room -= n * size
        at = min(at, bisect_right(stock.sizes, room)) - 1
    return as_filling(used)


def dominated(used: dict[int, int], room: int, stock: Stock) -> bool:
    """Whether a piece of the filling could be swapped for a larger one that is left and still fits."""
    if not room:
        return False
    for size in list(used)[1:]:
        k = bisect_right(stock.sizes, size)
        while k < len(stock.sizes) and stock.sizes[k] <= size + room:
            if stock.left(stock.sizes[k], used) > 0:
                return True
            k += 1
    return False


def completions(stock: Stock, capacity: int, look: int | None = LOOK) -> list[tuple[int, Filling]]:
    """Undominated fillings around the largest piece, least waste first."""
    largest = stock.sizes[-1]
    found: dict[Filling, int] = {}
    steps = 0

    def extend(used: dict[int, int], room: int, at: int) -> bool:
        nonlocal steps
        at = min(at, bisect_right(stock.sizes, room) - 1)
        while at >= 0 and not stock.left(stock.sizes[at], used):
            at -= 1
        if at < 0:
            if not dominated(used, room, stock):
                found.setdefault(as_filling(used), room)
            return room == 0
        while at >= 0 and (look is None or steps < look):
            size = stock.sizes[at]
            if stock.left(size, used):
                steps += 1
                used[size] = used.get(size, 0) + 1
                exact = extend(used, room - size, at)
                used[size] -= 1
                if not used[size]:
                    del used[size]
                if exact:
                    return True
            at -= 1
        return False

    extend({largest: 1}, capacity - largest, len(stock.sizes) - 1)
    greedy = best_fit(stock, capacity)
    found.setdefault(greedy, capacity - sum(size * n for size, n in greedy))
    return sorted((waste, filling) for filling, waste in found.items())


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and with pieces that cannot share one.

    For each k, pieces over ``capacity - k`` are alone among those of length k and
    more; the other large ones leave known room for the smaller.
    """
    n = np.zeros(capacity + 1, np.int64)
    for size, times in counts.items():
        n[size] = times
    number = np.concatenate([[0], np.cumsum(n)])  # pieces shorter than the index
    total = np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k + 1]
    middle = number[capacity - k + 1] - number[half + 1]
    room = middle * capacity - (total[capacity - k + 1] - total[half + 1])
    rest = total[half + 1] - total[k] - room
    needed = alone + middle + np.maximum(0, -(-rest // capacity))
    return max(int(needed.max()), -(-int(total[-1]) // capacity))


def dive(counts: dict[int, int], capacity: int, choose) -> list[Pattern]:
    """A packing that takes the filling ``choose`` gives, as often as it can, until nothing is left."""
    stock, patterns = Stock(counts), []
    while stock.sizes:
        filling = choose(stock)
        copies = stock.copies(filling)
        stock.change(filling, -copies)
        patterns.append((filling, copies))
    return patterns


def sequences(patterns: list[Pattern]) -> int:
    return sum(copies for _, copies in patterns)


def pack_lengths(
    counts: dict[int, int], capacity: int = CAPACITY, effort: int = EFFORT, look: int | None = LOOK
) -> list[Pattern]:
    """Patterns that pack ``counts[length]`` pieces of each length into few sequences.

    Without bounds on ``effort`` and ``look`` the search is complete.
    """
    counts = {size: n for size, n in counts.items() if n > 0}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must lie between 1 and the capacity")
    bound = lower_bound(counts, capacity)
    best = dive(counts, capacity, lambda s: best_fit(s, capacity))
    if sequences(best) > bound:
        tight = dive(counts, capacity, lambda s: completions(s, capacity, look)[0][1])
        best = min(best, tight, key=sequences)
    return best if sequences(best) == bound else branch_and_bound(counts, capacity, best, bound, effort, look)


def branch_and_bound(
    counts: dict[int, int], capacity: int, best: list[Pattern], bound: int, effort: int, look: int | None = LOOK
) -> list[Pattern]:
    """Depth-first over fillings; a branch may waste no more than a better packing could."""
    total = sum(size * n for size, n in counts.items())
    stock, path, used, wasted = Stock(counts), [], 0, 0
    frames = [iter(completions(stock, capacity, look))]
    while frames and effort > 0:
        effort -= 1
        step = next(frames[-1], None)
        if step is None:
            frames.pop()
            if path:
                filling, copies, waste = path.pop()
                stock.change(filling, copies)
                used, wasted = used - copies, wasted - waste * copies
            continue
        waste, filling = step
        copies = stock.copies(filling)
        if wasted + waste * copies > (sequences(best) - 1) * capacity - total:
            copies = 1
            if wasted + waste > (sequences(best) - 1) * capacity - total:
                continue
        stock.change(filling, -copies)
        path.append((filling, copies, waste))
        used, wasted = used + copies, wasted + waste * copies
        if not stock.sizes:
            if used < sequences(best):
                best = [(f, n) for f, n, _ in path]
                if used == bound:
                    return best
            frames.append(iter(()))
        else:
            frames.append(iter(completions(stock, capacity, look)))
    return best


class Slots:
    """Sequence and offset of a piece from its length and its rank among pieces of that length."""

    SHIFT = 44

    def __init__(self, patterns: list[Pattern]):
        rows, next_rank, sequence = [], {}, 0
        for filling, copies in patterns:
            offset = 0
            for size, n in filling:
                rank = next_rank.get(size, 0)
                rows.append(((size << self.SHIFT) + rank, n, sequence, offset))
                next_rank[size] = rank + n * copies
                offset += size * n
            sequence += copies
        rows.sort()
        self.key, self.n, self.sequence, self.offset = (
            np.array(x, np.int64) for x in (zip(*rows) if rows else ([], [], [], []))
        )

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(size):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = (size.astype(np.int64) << self.SHIFT) + rank
        run = np.searchsorted(self.key, key, side="right") - 1
        copy, place = np.divmod(key - self.key[run], self.n[run])
        return self.sequence[run] + copy, self.offset[run] + place * size


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids``: documents with their end id, cut at the capacity only.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers.
    """
    columns = docs.select("doc_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokenizer(tokenizer)
        for whole in batches:
            for batch in text_batches(whole, 1, SLICE_BYTES):
                ids, begin = encoder.encode_texts(batch.column(1))
                n = batch.num_rows
                stream = np.empty(len(ids) + n, "<u4")
                body = np.ones(len(stream), bool)
                body[begin[1:] + np.arange(n)] = False
                stream[body], stream[~body] = ids, end_id
                first = begin + np.arange(n + 1)
                length = np.diff(first)
                pieces = -(-length // capacity)
                doc = np.repeat(np.arange(n), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                size = np.minimum(capacity, length[doc] - start)
                offsets = np.concatenate([first[doc] + start, first[-1:]]).astype(np.int32) * 4
                binary = pa.Array.from_buffers(
                    pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(stream)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), binary],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return columns.mapInArrow(
        cut, f"doc_id {dict(columns.dtypes)['doc_id']}, piece int, start long, length long, ids binary"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, effort: int = EFFORT, look: int | None = LOOK) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has ``doc_id, piece, length`` and anything else but the two results; it
    is read several times and should be a written table. Ranks within a length come
    from counts per (length, salt), as many salts as the square root of the rows, so
    neither a frequent length nor the table of counts meets in one task.
    """
    salt, n, base, row, rank = free_names(pieces, "_salt", "_n", "_base", "_row", "_rank")
    salts = max(1, math.isqrt(pieces.count()))
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(F.lit(5), "doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", salt).agg(F.count("*").alias(n))
    counts = {r["length"]: r["total"] for r in groups.groupBy("length").agg(F.sum(n).alias("total")).collect()}
    slots = Slots(pack_lengths(counts, capacity, effort, look))

    below = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", salt, F.coalesce(F.sum(n).over(below), F.lit(0)).alias(base))
    within = Window.partitionBy("length", salt).orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn(row, F.row_number().over(within))
        .join(bases, ["length", salt])
        .select(*pieces.columns, (F.col(base) + F.col(row) - 1).alias(rank))
    )
    result = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    at = pieces.columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(at).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            sequence, offset = slots.find(size, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=result.names
            )

    return ranked.mapInArrow(place, result)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    payload: Column | None = None,
    effort: int = EFFORT,
    look: int | None = LOOK,
) -> DataFrame:
    """``doc_id, piece, start, length, sequence_id, offset`` and each piece's ids.

    ``payload`` replaces the ids by an expression over them before anything is
    written or moved.
    """
    pieces = token_pieces(docs, tokenizer, end_id, capacity)
    kept = F.col("ids") if payload is None else payload
    return pack(materialize(pieces.select("doc_id", "piece", "start", "length", kept), "pieces"), capacity, effort, look)
