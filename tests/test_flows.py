import contextlib
import io

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_queries import compare, connect
from wareloom.operators.clean import DistinctRows
from wareloom.operators.entity import entity_aggregate
from wareloom.plans import preprocessing
from wareloom.plans.business import condition_shares
from wareloom.plans.driver_tables import listing_documents, listing_rows
from wareloom.plans.preprocessing import document_parts, preprocess, preprocessing_stages, times_first
from wareloom.sources.listings import write_listings
from wareloom.streaming.apply import apply_stages, read_listing_stream, row_stages

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 10


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, ORACLES[name]) is None


def test_fitted_stages_save_load_and_freeze_the_schema(spark, tmp_path):
    docs = listing_documents(spark, SF)
    fitted, table = preprocess(docs)
    path = str(tmp_path / "stages")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    again = loaded.transform(docs)
    assert again.schema == table.schema
    assert again.exceptAll(table).count() == 0
    # A batch without optional content keeps the fitted columns.
    few = loaded.transform(docs.withColumn("attributes", F.lit(None).cast(docs.schema["attributes"].dataType)))
    assert few.columns == table.columns


def test_hot_id_is_a_part_of_its_own_with_the_same_result(spark):
    docs = listing_documents(spark, SF)
    copies = docs.where("id = 'L1'").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(700)))).drop("copy")
    many = docs.unionByName(copies)
    (whole,) = document_parts(docs)
    assert "REPARTITION_BY_COL" in plan_of(whole)
    rest, hot = document_parts(many)
    assert "REPARTITION_BY_COL" in plan_of(rest) and "REPARTITION_BY_COL" not in plan_of(hot)
    assert {r.id for r in hot.collect()} == {"L1"} and rest.count() == docs.count() - 1
    _, once = preprocess(docs)
    _, hot = preprocess(many)
    assert hot.exceptAll(once).count() == 0 and hot.count() == once.count()


def test_fitted_stages_apply_without_moving_flat_rows(spark):
    docs = listing_documents(spark, SF)
    fitted, table = preprocess(docs)
    again = preprocessing.apply_fitted(fitted, docs.unionByName(docs.where("id = 'L1'")))
    assert again.schema == table.schema and again.exceptAll(table).count() == 0 and again.count() == table.count()
    (whole,) = document_parts(docs)
    moved = preprocessing.apply_fitted(PipelineModel(fitted.stages[:5]), docs)
    # The distinct rows are written; before that only documents were shuffled.
    assert moved.count() == PipelineModel(fitted.stages[:5]).transform(whole).count()
    assert "Exchange" not in plan_of(moved)


def test_unneeded_columns_are_not_written(spark, monkeypatch):
    written = []
    real = preprocessing.materialize
    monkeypatch.setattr(preprocessing, "materialize", lambda df, name: written.append((name, df.columns)) or real(df, name))
    preprocess(listing_documents(spark, SF))
    (columns,) = [c for name, c in written if name == "distinct"]
    assert not [c for c in columns if "pic_" in c or "thumbnail" in c or c in ("permalink", "descriptions")]


def test_entities_read_the_rows_once(spark):
    plan = plan_of(entity_aggregate(listing_rows(spark, SF), "product_id"))
    assert plan.count("/lineitem.parquet") == 1
    shares = plan_of(condition_shares(listing_rows(spark, SF)))
    assert shares.count("/lineitem.parquet") == 1


def test_no_plan_deals_rows_out_in_turn(spark):
    assert "RoundRobin" not in plan_of(listing_rows(spark, SF)) + plan_of(listing_documents(spark, SF))


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_distinct_of_clustered_documents_moves_no_exploded_rows(spark):
    (rows,) = document_parts(listing_documents(spark, SF))
    for stage in preprocessing_stages()[:3]:
        rows = stage.transform(rows)
    lines = plan_of(rows.dropDuplicates()).splitlines()
    generate = max(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert not any("Exchange" in line for line in lines[:generate])


def test_row_stages_run_on_a_stream(spark, tmp_path):
    docs = listing_documents(spark, SF)
    fitted, _ = preprocess(docs, key=None)
    folder = write_listings(docs, str(tmp_path / "in"))
    stages = row_stages(fitted)
    stream = apply_stages(read_listing_stream(spark, folder), stages)
    run = stream.writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    run.processAllAvailable()
    run.stop()
    batch = apply_stages(docs, stages)
    assert spark.table("cleaned").exceptAll(batch).count() == 0
    assert spark.table("cleaned").count() == batch.count()
    with pytest.raises(ValueError):
        apply_stages(docs, [DistinctRows()])


def test_times_are_parsed_before_lists_multiply_the_rows(spark):
    rows = [
        ("A", ["x", "y"], ' "2015-01-02T03:04:05.678Z"', 1420000000000, "2015-01-02 03:04:05", "2015-09-10 11:12:13"),
        ("A", [], "1420000000000", None, "open end", None),
        (None, None, None, 7, None, "7"),
    ]
    docs = spark.createDataFrame(rows, "id string, tags array<string>, date_created string, last_update_time long, stop_time string, ` Start Time` string")
    docs = docs.withColumn("pictures", F.transform("tags", lambda t: F.struct(t.alias("id"), F.lit("2015-01-02T03:04:05.6Z").alias("date"))))
    stages = preprocessing_stages()[:3]
    early = times_first(stages, docs)
    kinds = dict(early.dtypes)
    assert [kinds[c] for c in ("date_created", "last_update_time", "stop_time", " Start Time")] == ["timestamp_ntz"] * 3 + ["string"]
    assert early.columns == docs.columns and times_first(preprocessing_stages()[3:], docs) is docs
    late, flat = (PipelineModel(stages).transform(df) for df in (docs, early))
    assert flat.schema == late.schema and dict(flat.dtypes)["pic_date"] == "timestamp_ntz"
    found = [sorted(map(str, df.collect())) for df in (late, flat)]
    assert found[0] == found[1] and len(found[0]) == 4
