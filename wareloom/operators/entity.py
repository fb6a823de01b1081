"""One row per product, seller or site: modes, representative values and sums.

Rows of most keys are brought together once and reduced where they lie, in sorted
order and a bounded piece at a time. A key with a large part of all rows stays spread:
its rows become counted cells, so that no task holds all of its values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.columns import amount, hours_between
from wareloom.operators.skew import HOT_SHARE
from wareloom.schema import FIRST_COLUMNS, HELPER_COLUMNS, MODAL_COLUMNS, SUM_COLUMNS
from wareloom.session import workers_find_package
from wareloom.sources.store import materialize

NUMBERS_SLOT = -1
#: Rows of a key that a task may always hold, however small the table.
HOT_ROWS = 20_000
#: Rows reduced at once, with those of the last key kept for the next piece.
PIECE_ROWS = 100_000


def mode_counts(df: DataFrame, key: str, columns: list[str], nulls: str = "count") -> DataFrame:
    """(key, slot, value, n): how often each value of each column occurs per key.

    Counting by key *and* value spreads a hot key over as many tasks as it has
    values, and a hot value is combined before the shuffle. No task holds all
    values of a group, which ``mode`` would require.
    """
    if nulls not in ("count", "ignore"):
        raise ValueError(f"nulls must be 'count' or 'ignore', not {nulls!r}")
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    long = df.select(F.col(key), F.posexplode(cells).alias("slot", "value"))
    if nulls == "ignore":
        long = long.where(F.col("value").isNotNull())
    return long.groupBy(key, "slot", "value").agg(F.count("*").alias("n"))


def pick_mode(slot: int):
    """The most frequent value of a slot; ties go to the smallest, null last."""
    rank = F.struct(-F.col("n"), F.col("value").isNull(), F.col("value"))
    return F.min_by("value", F.when(F.col("slot") == slot, rank))


def group_modes(df: DataFrame, key: str, columns: dict[str, str], nulls: str = "count") -> DataFrame:
    counts = mode_counts(df, key, list(columns), nulls)
    picks = [
        pick_mode(i).cast(df.schema[source].dataType).alias(out)
        for i, (source, out) in enumerate(columns.items())
    ]
    return counts.groupBy(key).agg(*picks)


def _deduplicated(df: DataFrame, key: str) -> DataFrame:
    """One row per product before sums are taken: quantities counted once."""
    numbers = ["price", *FIRST_COLUMNS, *SUM_COLUMNS]
    once = df.groupBy("product_id", key) if key != "product_id" else df.groupBy(key)
    # The smallest row in the declared order stands for the product.
    order = F.struct(*FIRST_COLUMNS, "price", *SUM_COLUMNS)
    return once.agg(F.min(order).alias("one")).select(key, *[F.col(f"one.{c}").alias(c) for c in numbers])


def _numbers(df: DataFrame, key: str) -> DataFrame:
    """The first row by the declared order and the sums, per key."""
    return df.groupBy(key).agg(
        F.min(F.struct(*FIRST_COLUMNS, "price")).alias("first_row"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{out}") for c, out in SUM_COLUMNS.items()],
    )


def _slots(df: DataFrame, key: str, modal: dict[str, str], nulls: str, with_numbers: bool) -> DataFrame:
    """(key, slot, value, n, first_row, sums): counted cells of the modal columns, and of the numbers.

    Equal rows of a key are counted before the fan-out. Then every distinct row
    becomes one cell per modal column and one cell for its numbers, which are
    counted together: the input is read and joined once. Grouping by value spreads
    a hot key over its values; the numbers of a row are part of the grouping in
    their cell, so that the first row needs no ordered buffer.
    """
    if nulls not in ("count", "ignore"):
        raise ValueError(f"nulls must be 'count' or 'ignore', not {nulls!r}")
    order = [*FIRST_COLUMNS, "price"] if with_numbers else []
    sums = SUM_COLUMNS if with_numbers else {}
    kind = {f.name: f.dataType for f in df.schema.fields}
    rows = df.groupBy(*dict.fromkeys([key, *modal, *order])).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{out}") for c, out in sums.items()]
    )

    def cell(slot: int, value: Column, filled: bool) -> Column:
        return F.struct(
            F.lit(slot).alias("slot"),
            value.alias("value"),
            *[(F.col(c) if filled else F.lit(None).cast(kind[c])).alias(f"first_{c}") for c in order],
            *[(F.col(f"_sum_{out}") if filled else F.lit(None).cast(kind[c])).alias(f"part_{c}") for c, out in sums.items()],
        )

    cells = [cell(i, F.col(c).cast("string"), False) for i, c in enumerate(modal)]
    if with_numbers:
        cells.append(cell(NUMBERS_SLOT, F.lit(None).cast("string"), True))
    long = rows.select(F.col(key), "_n", F.inline(F.array(*cells)))
    if nulls == "ignore":
        long = long.where(F.col("value").isNotNull() | (F.col("slot") == NUMBERS_SLOT))
    counted = long.groupBy(key, "slot", "value", *[f"first_{c}" for c in order]).agg(
        F.sum("_n").alias("n"), *[F.sum(f"part_{c}").alias(f"sum_{out}") for c, out in sums.items()]
    )
    if not with_numbers:
        return counted
    first = F.struct(*[F.col(f"first_{c}").alias(c) for c in order])
    return counted.withColumn("first_row", F.when(F.col("slot") == NUMBERS_SLOT, first)).drop(*[f"first_{c}" for c in order])


def _per_key(slots: DataFrame, key: str, modal: dict[str, str], with_numbers: bool = True) -> DataFrame:
    """One row per key: first the best cell of every slot, then the slots of a key side by side."""
    rank = F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("empty"), "value")
    sums = [f"sum_{out}" for out in SUM_COLUMNS.values()] if with_numbers else []
    first = [F.min("first_row").alias("first_row")] if with_numbers else []
    best = slots.groupBy(key, "slot").agg(F.min(rank).alias("best"), *first, *[F.sum(c).alias(c) for c in sums])
    return best.groupBy(key).agg(
        *[F.max(F.when(F.col("slot") == i, F.col("best.value"))).alias(f"mode_{out}") for i, out in enumerate(modal.values())],
        *first,
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
    )


def _dense(column: pa.Array, null_last: bool = False) -> tuple[np.ndarray, int, pa.Array]:
    """Places of the values in ascending order, null before or after all; how many, and the sorted values."""
    coded = column.dictionary_encode()
    values = coded.dictionary
    # Not a number is the greatest value, after infinity.
    order = pc.sort_indices(values, null_placement="at_end").to_numpy()
    place = np.empty(len(order) + 1, np.int64)
    place[order] = np.arange(len(order))
    place[-1] = len(order) if null_last else -1
    codes = pc.fill_null(coded.indices, len(order)).to_numpy(zero_copy_only=False)
    return place[codes] + (not null_last), len(order) + 1, values.take(pa.array(order))


def _mode(groups: np.ndarray, n_groups: int, column: pa.Array, nulls: str) -> pa.Array:
    """The most frequent value of each group; ties go to the smallest, null last."""
    place, width, values = _dense(column, null_last=True)
    cell = groups * width + place
    if nulls == "ignore":
        cell = cell[place < width - 1]
    cell = np.sort(cell)
    begin = np.flatnonzero(np.diff(cell, prepend=-1))
    n, group, place = np.diff(np.append(begin, len(cell))), cell[begin] // width, cell[begin] % width
    order = np.lexsort((place, -n, group))
    best = order[np.flatnonzero(np.diff(group[order], prepend=-1))]
    found = np.full(n_groups, width - 1)
    found[group[best]] = place[best]
    return values.take(pa.array(found, mask=found == width - 1))


def _sums(begin: np.ndarray, groups: np.ndarray, column: pa.Array, kind: pa.DataType) -> pa.Array:
    """Sums of the known values of each group, null without any."""
    if pa.types.is_integer(column.type):
        known = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
        # Far from the limit whole numbers add up exactly; near it the library's own check decides.
        if np.abs(known.astype(np.float64)).sum() >= 2.0**62:
            exact = np.add.reduceat(known.astype(object), begin).tolist()
            if any(not -(2**63) <= v < 2**63 for v in exact):
                raise OverflowError("a sum of whole numbers exceeds 64 bits")
            sums = np.array(exact, np.int64)
        else:
            sums = np.add.reduceat(known.astype(np.int64), begin)
        empty = np.add.reduceat(column.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), begin) == 0
        return pa.array(sums, mask=empty).cast(kind)
    found = pa.table({"g": pa.array(groups), "v": column}).group_by("g", use_threads=False).aggregate([("v", "sum")])
    return found.column("v_sum").combine_chunks().cast(kind)


def _narrow(column: pa.Array) -> pa.Array:
    return column.cast(pa.string()) if pa.types.is_large_string(column.type) else column


def _sum_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    return T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()


def _together(df: DataFrame, key: str, modal: dict[str, str], nulls: str, with_numbers: bool) -> DataFrame:
    """One row per key, like ``_per_key``, of rows that are shuffled once, by key, and sorted by it."""
    workers_find_package(df.sparkSession)
    order = [*FIRST_COLUMNS, "price"] if with_numbers else []
    sums = SUM_COLUMNS if with_numbers else {}
    kind = {f.name: f.dataType for f in df.schema.fields}
    texts = [F.col(c).cast("string").alias(f"mode_{out}") for c, out in modal.items()]
    firsts = [F.col(c).alias(f"first_{c}") for c in order]
    parts = [F.col(c).cast(_sum_type(kind[c])).alias(f"sum_{out}") for c, out in sums.items()]
    # The given columns are shuffled; casts and copies come after that.
    near = df.select(*dict.fromkeys([key, *modal, *order, *sums])).repartition(key).sortWithinPartitions(key)
    rows = near.select(F.col(key), *texts, *firsts, *parts)
    fields = [T.StructField(key, kind[key])]
    fields += [T.StructField(f"mode_{out}", T.StringType()) for out in modal.values()]
    fields += [T.StructField(f"first_{c}", kind[c]) for c in order]
    fields += [T.StructField(f"sum_{out}", _sum_type(kind[c])) for c, out in sums.items()]
    n_modes, n_order = len(modal), len(order)

    def reduced(rows: pa.RecordBatch, begin: np.ndarray) -> pa.RecordBatch:
        size = np.diff(np.append(begin, rows.num_rows))
        groups = np.repeat(np.arange(len(begin)), size)
        modes = [_mode(groups, len(begin), rows.column(1 + i), nulls) for i in range(n_modes)]
        first = rows.columns[1 + n_modes : 1 + n_modes + n_order]
        if first:
            place = np.lexsort([_dense(c)[0] for c in reversed(first)] + [groups])[begin]
            first = [c.take(pa.array(place)) for c in first]
        added = [_sums(begin, groups, c, c.type) for c in rows.columns[1 + n_modes + n_order :]]
        ids = rows.column(0).take(pa.array(begin))
        return pa.RecordBatch.from_arrays([_narrow(c) for c in (ids, *modes, *first, *added)], rows.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def piece(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            rows = pa.concat_batches(held)
            codes = rows.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.diff(codes, prepend=-1))
            end = rows.num_rows if last else int(begin[-1])
            if end:
                yield reduced(rows.slice(0, end), begin if last else begin[:-1])
            held = [] if last else [rows.slice(end)]
            # A key longer than a piece is looked at again only when its rows have doubled.
            n = 0 if last else -(rows.num_rows - end if end == 0 else 0)

        for batch in batches:
            if batch.num_rows:
                # Texts of a piece may exceed the offsets of a batch.
                wide = [c.cast(pa.large_string()) if pa.types.is_string(c.type) else c for c in batch.columns]
                held.append(pa.RecordBatch.from_arrays(wide, batch.schema.names))
                n += batch.num_rows
            if n >= PIECE_ROWS:
                yield from piece(last=False)
        if held:
            yield from piece(last=True)

    found = rows.mapInArrow(run, T.StructType(fields))
    if not with_numbers:
        return found
    return found.select(
        key,
        *[f"mode_{out}" for out in modal.values()],
        F.struct(*[F.col(f"first_{c}").alias(c) for c in order]).alias("first_row"),
        *[F.coalesce(F.col(f"sum_{out}"), F.lit(0)).alias(f"sum_{out}") for out in sums.values()],
    )


def _reduced(df: DataFrame, key: str, modal: dict[str, str], nulls: str, with_numbers: bool, hot_rows: int) -> DataFrame:
    """One row per key: ``_together`` for most keys, counted cells for those with a large part of the rows."""
    if nulls not in ("count", "ignore"):
        raise ValueError(f"nulls must be 'count' or 'ignore', not {nulls!r}")
    counts = materialize(df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows")), "key-counts")
    rows, keys = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count("*")).first()
    # At most 1 / HOT_SHARE keys.
    hot = counts.where(F.col("_rows") > max(hot_rows, rows * HOT_SHARE)).select("_hot")
    n_hot = hot.count()
    if not n_hot:
        return _together(df, key, modal, nulls, with_numbers)
    if n_hot == keys:
        return _per_key(_slots(df, key, modal, nulls, with_numbers), key, modal, with_numbers)
    same = F.col(key).eqNullSafe(F.col("_hot"))
    cold = _together(df.join(F.broadcast(hot), same, "left_anti"), key, modal, nulls, with_numbers)
    spread = df.join(F.broadcast(hot), same, "left_semi")
    return cold.unionByName(_per_key(_slots(spread, key, modal, nulls, with_numbers), key, modal, with_numbers))


def entity_aggregate(
    df: DataFrame,
    key: str,
    nulls: str = "count",
    grain: str = "fanout",
    keep_helpers: bool = False,
    ordered: bool = True,
    modes: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Aggregate listing rows to one row per ``key`` (null is a key of its own).

    ``grain="fanout"`` sums quantities over every flattened row, so a listing
    with several nested elements counts several times; ``grain="entity"`` sums
    each product once. Representative values come from the first row by
    ``last_updated, date_created, start_time, stop_time, price``. ``modes``
    limits the modal output columns to those a caller needs. A key of more than
    ``hot_rows`` rows and 0.1 % of all stays spread over the tasks; the rows of the
    keys are counted for that by a job of its own.
    """
    if grain not in ("fanout", "entity"):
        raise ValueError(f"grain must be 'fanout' or 'entity', not {grain!r}")
    modal = {c: out for c, out in MODAL_COLUMNS.items() if modes is None or out in modes}
    if grain == "entity":
        numbers = _numbers(_deduplicated(df, key), key)
        if modal:
            # Sums over products and modes over rows: two groupings, met by key.
            halves = _reduced(df, key, modal, nulls, False, hot_rows).unionByName(numbers, allowMissingColumns=True)
            modes_ = [F.max(f"mode_{out}").alias(f"mode_{out}") for out in modal.values()]
            sums = [F.coalesce(F.sum(f"sum_{out}"), F.lit(0)).alias(f"sum_{out}") for out in SUM_COLUMNS.values()]
            numbers = halves.groupBy(key).agg(*modes_, F.min("first_row").alias("first_row"), *sums)
    elif modal:
        numbers = _reduced(df, key, modal, nulls, True, hot_rows)
    else:
        numbers = _numbers(df, key)

    result = numbers.select(
        key,
        *[F.col(f"mode_{out}").cast(df.schema[c].dataType).alias(out) for c, out in modal.items()],
        F.col("first_row.price").alias("unit_price"),
        *[F.col(f"sum_{out}").alias(out) for out in SUM_COLUMNS.values()],
        *[F.col(f"first_row.{c}").alias(c) for c in FIRST_COLUMNS],
    ).withColumns(
        {
            "total_amount": amount(F.col("unit_price"), F.col("total_quantity")),
            "date_difference_hr": hours_between(F.col("date_created"), F.col("last_updated")),
            "time_difference_hr": hours_between(F.col("start_time"), F.col("stop_time")),
        }
    )
    if ordered:
        # Ordering reads its rows twice; the shuffle in between keeps the work before it from running twice.
        result = result.repartition(key).orderBy(F.col("total_amount").desc_nulls_first(), key)
    return result if keep_helpers else result.drop(*HELPER_COLUMNS)
