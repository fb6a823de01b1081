from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wareloom.functions.columns import hash_unit, hours_between, log_amount
from wareloom.operators.clean import (
    CastNumbers,
    DropColumns,
    DropUnneeded,
    NormalizeNames,
    NullTokens,
    ParseTimes,
    RenameColumns,
    TrimLower,
)
from wareloom.operators.decide import (
    DetectNumbers,
    DropSparseColumns,
    columns_within,
    duplicate_columns,
    variable_info,
    variable_kinds,
)
from wareloom.schema import NULL_TOKENS


def test_null_tokens_are_exact(spark):
    texts = [*NULL_TOKENS, " NULL", "Null", "na", None, "kept"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = [r.t for r in NullTokens().transform(df).collect()]
    assert kept == [None] * len(NULL_TOKENS) + [" NULL", "Null", "na", None, "kept"]


def test_trim_handles_tabs_and_unicode_space(spark):
    df = spark.createDataFrame([("\t New \n",), (None,), ("  ",)], "t string")
    assert [r.t for r in TrimLower().transform(df).collect()] == ["new", None, ""]


def test_times_by_name_and_type(spark):
    df = spark.createDataFrame(
        [('"2015-09-05T20:42:58.123Z" ', 1441485773000, "2015-11-04 20:42:53", 1.5), ("soon", None, "x", 2.0)],
        "date_created string, start_time bigint, stop_time string, time_share double",
    )
    first, second = ParseTimes().transform(df).collect()
    assert first.date_created == datetime(2015, 9, 5, 20, 42, 58, 123000)
    assert first.start_time == datetime(2015, 9, 5, 20, 42, 53)
    assert first.stop_time == datetime(2015, 11, 4, 20, 42, 53)
    assert (second.date_created, second.start_time, second.stop_time) == (None, None, None)
    assert first.time_share == 1.5


def test_times_in_either_layout(spark):
    df = spark.createDataFrame(
        [("1446669773000", 1446669773000, "2015-11-04 20:42:53"), ("2015-11-04 20:42:53", None, "-1000")],
        "start_time string, stop_time bigint, other_time string",
    ).select("start_time", "stop_time", F.col("other_time").alias("stop_time_text"))
    rows = ParseTimes().transform(df.withColumnRenamed("stop_time_text", "Stop_Time2")).collect()
    assert rows[0].start_time == rows[0].stop_time == rows[1].start_time == datetime(2015, 11, 4, 20, 42, 53)
    texts = ["2015-09-05T20:42:58.1Z", "2015-09-05T20:42:58.123456Z", "2015-09-05T20:42:58.123456789Z", "2015-09-05T20:42:58Z"]
    dates = spark.createDataFrame([(t,) for t in texts], "date_created string")
    got = [r.date_created for r in ParseTimes().transform(dates).collect()]
    assert [g and g.microsecond for g in got] == [100000, 123456, 123456, None]


def test_names_are_normalized_and_clashes_refused(spark):
    df = spark.createDataFrame([(1, 2)], "` A b` int, C int")
    assert NormalizeNames().transform(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        NormalizeNames().transform(spark.createDataFrame([(1, 2)], "x int, `x ` int"))


def test_rename_is_strict(spark):
    df = spark.createDataFrame([(1, 2)], "base_price int, price int")
    with pytest.raises(ValueError):
        RenameColumns(mapping={"absent": "x"}).transform(df)
    with pytest.raises(ValueError):
        RenameColumns(mapping={"base_price": "price"}).transform(df)
    with pytest.raises(ValueError):
        DropColumns(columns=["absent"], strict=True).transform(df)


def test_unneeded_columns(spark):
    df = spark.createDataFrame([([1], "a", "b", "c", "d", "e")], "l array<int>, pic_id string, my_thumbnail string, permalink string, descriptions string, title string")
    assert DropUnneeded().transform(df).columns == ["title"]


def test_duplicate_columns_ignore_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, None, 2, None, "x", None, None, None), (2, 2, None, 5, 1, None, "y", None, None, None)],
        "a int, copy int, partly int, apart int, other int, empty int, t string, void string, void2 double, void3 double",
    )
    # "partly" and "apart" never meet, so they count as equal; empty columns meet those of their type only.
    assert duplicate_columns(df) == ["copy", "partly", "apart", "void3"]
    assert duplicate_columns(df, require_overlap=True) == ["copy", "partly", "void3"]
    assert duplicate_columns(df, empty_equals_all=True) == ["copy", "partly", "apart", "empty", "void", "void3"]


def test_one_differing_row_is_found(spark):
    df = spark.range(5000).select(F.col("id").alias("a"), F.when(F.col("id") == 4999, -1).otherwise(F.col("id")).alias("b"))
    assert duplicate_columns(df.coalesce(1)) == []


def test_sparse_columns_of_the_worked_example(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 4, None)], "A int, B int, C int")
    assert DropSparseColumns(threshold=1 / 3).fit(df).option("columns") == ["B", "C"]
    assert DropSparseColumns(threshold=0.5).fit(df).option("columns") == []


def test_digit_text(spark):
    rows = [("1", "1.5", "1.2.3", "-1", None, "7", "."), ("22", ".5", "1", "2", None, "x", "1")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, my_id string, f string")
    fitted = DetectNumbers().fit(df)
    assert fitted.option("columns") == ["a", "b"]
    assert [r.b for r in fitted.transform(df).collect()] == [1.5, 0.5]
    assert CastNumbers(columns=["c"]).transform(df).first().c is None


def test_variable_kinds_and_info(spark):
    df = spark.range(100).select(
        F.col("id").alias("many"),
        F.when(F.col("id") > 5, F.col("id") % 4).alias("few"),
        (F.col("id") % 5).alias("five"),
        F.when(F.col("id") > 5, F.col("id") % 5).alias("five_and_null"),
        F.col("id").cast("string").alias("text"),
        F.lit(True).alias("flag"),
        F.current_timestamp().alias("at"),
    )
    kinds = variable_kinds(df)
    assert kinds["continuous"] == ["many", "five_and_null"]
    assert kinds["discrete"] == ["few", "five"]
    assert kinds["categorical"] == ["text", "flag"] and kinds["temporal"] == ["at"]
    info = variable_info(df, ["many"], ["text", "flag"], ["few"])
    assert info["discretes_more_than_threshold"] == ["few"]
    assert info["categoricals_high_cardinality"] == ["text"]
    assert info["categoricals_low_cardinality"] == ["flag"]
    assert columns_within(df, ["five_and_null"], 5, count_null=False) == {"five_and_null"}


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1), datetime(2020, 1, 1, 1, 30, 0, 900000), 0.0)], "a timestamp, b timestamp, x double")
    row = df.select(
        hours_between(F.col("a"), F.col("b")).alias("h"),
        hours_between(F.col("b"), F.col("a")).alias("back"),
        log_amount(F.col("x")).alias("log"),
        log_amount(F.col("x"), keep_infinite=True).alias("log_inf"),
    ).first()
    assert (row.h, row.back, row.log, row.log_inf) == (1.5, -1.5, None, float("-inf"))
    units = [r.u for r in spark.range(2000).select(hash_unit(F.col("id"), 1).alias("u")).collect()]
    assert 0 <= min(units) and max(units) < 1 and abs(sum(units) / 2000 - 0.5) < 0.03
