from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wareloom.operators import entity
from wareloom.operators.counts import rows_with_repeated_key, sample_rows, top_rows, varying_keys, weekday_counts, weekday_hours
from wareloom.operators.entity import entity_aggregate, group_modes
from wareloom.operators.skew import hot_keys, salted_join
from wareloom.schema import HELPER_COLUMNS, MODAL_COLUMNS


def test_mode_counts_nulls_or_ignores_them(spark):
    rows = [(1, v) for v in ["a", "a", "b", "b", None, None, None]] + [(2, "z"), (2, "y"), (2, None)]
    df = spark.createDataFrame(rows, "k int, c string")
    counted = {r.k: r.c for r in group_modes(df, "k", {"c": "c"}).collect()}
    ignored = {r.k: r.c for r in group_modes(df, "k", {"c": "c"}, nulls="ignore").collect()}
    assert counted == {1: None, 2: "y"}
    assert ignored == {1: "a", 2: "y"}


def test_mode_of_a_hot_key_matches_brute_force(spark):
    values = [(i % 3 == 0 and 0 or i % 50, f"v{(i * i) % 97}", i % 2 == 0) for i in range(6000)]
    df = spark.createDataFrame(values, "k int, c string, flag boolean")
    got = {r.k: (r.c, r.flag) for r in group_modes(df, "k", {"c": "c", "flag": "flag"}).collect()}
    for key in {v[0] for v in values}:
        texts, flags = Counter(v[1] for v in values if v[0] == key), Counter(v[2] for v in values if v[0] == key)
        best = min(texts, key=lambda t: (-texts[t], t)), min(flags, key=lambda f: (-flags[f], f))
        assert got[key] == best


def listing_frame(spark):
    base = {c: "x" for c in MODAL_COLUMNS}
    for flag in ("local_pickup", "free_shipping", "accepts_mercadopago", "automatic_relist"):
        base[flag] = True
    days = [datetime(2020, 1, d) for d in (1, 2, 3, 4)]
    rows = []
    for product, seller, sold in [("p1", 1, 2), ("p1", 1, 2), ("p2", 1, None), (None, 2, 5)]:
        rows.append((product, seller, "s", 10.0, sold, 4, 1, days[1], days[0], days[2], days[3], *base.values()))
    schema = (
        "product_id string, seller_id bigint, site_id string, price double, sold_quantity bigint, "
        "initial_quantity bigint, available_quantity bigint, last_updated timestamp, date_created timestamp, "
        "start_time timestamp, stop_time timestamp, "
        + ", ".join(f"{c} {'boolean' if v is True else 'string'}" for c, v in base.items())
    )
    return spark.createDataFrame(rows, schema)


def test_entity_sums_null_key_and_durations(spark):
    rows = listing_frame(spark)
    table = entity_aggregate(rows, "product_id")
    assert not set(HELPER_COLUMNS) & set(table.columns) and len(table.columns) == 22
    found = {r.product_id: r for r in table.collect()}
    assert set(found) == {"p1", "p2", None}
    assert (found["p1"].total_amount, found["p2"].total_amount, found[None].total_amount) == (40.0, 0.0, 50.0)
    assert found["p1"].date_difference_hr == 24.0 and found["p1"].time_difference_hr == 24.0
    assert found["p1"].local_pickup is True
    assert [r.product_id for r in table.collect()] == [None, "p1", "p2"]


def test_grain_counts_each_product_once(spark):
    rows = listing_frame(spark)
    fanout = {r.seller_id: r.total_quantity for r in entity_aggregate(rows, "seller_id", keep_helpers=True).collect()}
    once = {
        r.seller_id: r.total_quantity
        for r in entity_aggregate(rows, "seller_id", grain="entity", keep_helpers=True).collect()
    }
    assert fanout == {1: 4, 2: 5} and once == {1: 2, 2: 5}


def mixed_listings(spark, n=4000):
    """One key holds half of the rows, others a few; nulls, ties and repeated values in every column."""
    columns = [c for c in MODAL_COLUMNS if c not in ("local_pickup", "free_shipping", "accepts_mercadopago", "automatic_relist")]
    days = [datetime(2020, 1, 1 + d) for d in range(5)]
    rows = []
    for i in range(n):
        pick = lambda step, values: values[(i * step + i // 7) % len(values)]
        key = None if i % 101 == 0 else 1 if i % 2 else i % 300
        times = [pick(s, [None, *days]) for s in (3, 5, 7, 11)]
        price = pick(13, [None, 2.5, 1.0, float("nan"), -1.0])
        sums = [pick(s, [None, 1, 2, 3]) for s in (3, 5, 7)]
        flags = [pick(s, [None, True, False, True]) for s in (3, 5, 7, 9)]
        texts = [pick(s + 3, [None, "b", "a", "c", "b", "é", ""]) for s in range(len(columns))]
        rows.append((key, key, price, *sums, *times, *flags, *texts))
    return spark.createDataFrame(
        rows,
        "product_id bigint, seller_id bigint, price double, sold_quantity bigint, initial_quantity bigint, available_quantity bigint, "
        "last_updated timestamp, date_created timestamp, start_time timestamp, stop_time timestamp, local_pickup boolean, "
        "free_shipping boolean, accepts_mercadopago boolean, automatic_relist boolean, " + ", ".join(f"{c} string" for c in columns),
    ).repartition(6)


@pytest.mark.parametrize("nulls,grain", [("count", "fanout"), ("ignore", "entity")])
def test_rows_together_and_spread_cells_agree(spark, monkeypatch, nulls, grain):
    rows = mixed_listings(spark)

    def found(hot_rows):
        # Compared as text: not-a-number equals nothing.
        table = entity_aggregate(rows, "product_id", nulls, grain, keep_helpers=True, ordered=False, hot_rows=hot_rows)
        return sorted(map(str, table.collect()))

    spread = found(0)
    assert len(spread) == 152 and found(100) == spread
    monkeypatch.setattr(entity, "PIECE_ROWS", 10)
    assert found(10_000) == spread


def test_rows_of_common_keys_are_not_exploded(spark):
    found = entity_aggregate(mixed_listings(spark), "product_id", ordered=False)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "Generate" not in final and "MapInArrow" in final


def test_sums_beyond_64_bits_are_refused(spark):
    rows = mixed_listings(spark, 40).withColumn("sold_quantity", F.lit(2**62 + 5))
    with pytest.raises(Exception, match="64 bits"):
        entity_aggregate(rows, "product_id").collect()
    assert entity_aggregate(rows.limit(1), "product_id", keep_helpers=True).first().total_quantity == 2**62 + 5


def test_repeated_key_keeps_all_copies_of_a_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)] + [(None, 1), (None, 2), (5000, 1)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(8)
    kept = rows_with_repeated_key(df, "k").collect()
    assert Counter(r.k for r in kept) == {0: 1000, None: 2}
    assert len({(r.k, r.v) for r in kept}) == 1002


def test_salted_join_equals_plain_join(spark):
    df = spark.createDataFrame([(0 if i % 3 == 0 else i % 100, i) for i in range(4000)], "k int, v int").repartition(8)
    names = spark.createDataFrame([(i, f"n{i}") for i in range(0, 90)], "k int, name string")
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    assert hot_keys(counts, "k").count() <= 1000
    salted = salted_join(df, names, "k", counts, "left").select("k", "v", "name")
    plain = df.join(names, "k", "left").select("k", "v", "name")
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


def test_varying_values(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "a"), (2, 3.0, None), (2, 3.0, None)], "k int, x double, t string")
    rows = varying_keys(df, "k", ["x", "t"]).collect()
    assert [(r.k, r.n_x, r.n_t) for r in rows] == [(1, 2, 1)]


def test_top_and_sample(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)] + [(99, None)], "id int, x double")
    assert [r.id for r in top_rows(df, "x", "id", 3).collect()] == [99, 6, 13]
    first = {r.id for r in sample_rows(df, "id", 10, 1).collect()}
    again = {r.id for r in sample_rows(df.repartition(5), "id", 10, 1).collect()}
    assert first == again and len(first) == 10


def test_calendar_keeps_absent_days(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 1, 7),), (datetime(2024, 1, 3, 7),)], "t timestamp")
    counts = {r.label: r.n for r in weekday_counts(df, ["t"]).collect()}
    assert counts == {"Lunes": 2, "Martes": 0, "Miércoles": 1, "Jueves": 0, "Viernes": 0, "Sábado": 0, "Domingo": 0}
    rows = {r.weekday: r for r in weekday_hours(df, ["t"]).collect()}
    assert (rows["Monday"].h05, rows["Monday"].h06, rows["Tuesday"].h05) == (1, 0, None)
