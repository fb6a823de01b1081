import math
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wareloom.operators import engineer as E
from wareloom.operators import evaluate as M
from wareloom.operators import fitted
from wareloom.operators import select as V
from wareloom.operators import split as L
from wareloom.operators import train as T
from wareloom.plans import training as W
from wareloom.settings import BoostingParams, Settings
from wareloom.sources import store


def classes(spark, sizes):
    rows = [(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "id int, target string")


@pytest.mark.parametrize("sizes", [{"new": 551, "used": 449}, {"new": 7, "used": 3}, {"new": 333, "used": 1, "old": 67}])
def test_split_sizes_are_exact_per_class(spark, sizes):
    df = classes(spark, sizes)
    model = L.StratifiedSplit(target="target", key="id", seed=25).fit(df)
    found = Counter((r.target, r.split) for r in model.transform(df).collect())
    wanted = L.split_sizes(sizes)
    for c, n in sizes.items():
        train, val = wanted[c]
        assert abs(train - 0.6 * n) <= 1 and abs(val - 0.2 * n) <= 1.5
        assert (found[(c, "train")], found[(c, "val")]) == (train, val)
        assert found[(c, "test")] == n - train - val


def test_split_does_not_depend_on_partitioning(spark):
    df = classes(spark, {"new": 200, "used": 100})
    stage = L.StratifiedSplit(target="target", key="id", seed=3)
    one = {r.id: r.split for r in stage.fit(df).transform(df).collect()}
    other = df.repartition(7)
    assert one == {r.id: r.split for r in stage.fit(other).transform(other).collect()}


def test_rank_cut_matches_sorting(spark):
    hashed = spark.range(5000).select(F.lit("c").alias("class"), F.md5(F.col("id").cast("string")).alias("hash"))
    order = sorted(r.hash for r in hashed.collect())
    cuts = L.rank_cut(hashed, {"c": [0, 1, 2500, 5000]}, digits=1)
    for i, k in enumerate([0, 1, 2500, 5000]):
        assert sum(h < cuts[("c", i)] for h in order) == k


def test_folds_are_balanced(spark):
    df = classes(spark, {"new": 100, "used": 57})
    model = L.StratifiedFolds(target="target", key="id", folds=10).fit(df)
    found = Counter((r.target, r.fold) for r in model.transform(df).collect())
    assert {found[("new", f)] for f in range(10)} == {10}
    assert {found[("used", f)] for f in range(10)} <= {5, 6}


def test_label_order_and_unseen_class(spark):
    df = classes(spark, {"used": 2, "new": 3})
    model = L.EncodeLabel(target="target").fit(df)
    assert {(r.target, r.label) for r in model.transform(df).collect()} == {("new", 0.0), ("used", 1.0)}
    with pytest.raises(Exception):
        model.transform(classes(spark, {"other": 1})).collect()


def test_weights_are_class_shares(spark):
    df = classes(spark, {"new": 3, "used": 1})
    plain = L.ClassWeights(label="target").fit(df).transform(df)
    assert {(r.target, r.weight) for r in plain.collect()} == {("new", 0.75), ("used", 0.25)}
    inverse = L.ClassWeights(label="target", inverse=True).fit(df).transform(df)
    assert {(r.target, r.weight) for r in inverse.collect()} == {("new", 4 / 6), ("used", 2.0)}


def test_quasi_constant_counts_nulls_only_in_the_total(spark):
    rows = [("a", "a", None)] * 94 + [("a", "b", "z")] * 1 + [("b", "b", "z")] * 5
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert V.DropQuasiConstant(columns=["x", "y", "z"], tol=0.95).fit(df).option("columns") == ["x"]


def test_correlated_scan_is_alphabetical(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("b"), (F.col("id") * 2.0).alias("a"), F.sin("id").alias("c"), (-F.col("id")).cast("double").alias("d")
    )
    assert V.DropCorrelated(columns=["b", "a", "c", "d"], threshold=0.8).fit(df).option("columns") == ["b", "d"]


def test_matching_columns_adds_typed_nulls(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "id int, c string, x double")
    model = V.MatchColumns(keep=["id"]).fit(df)
    other = spark.createDataFrame([(7, "z", 9)], "id int, c string, extra int")
    out = model.transform(other)
    assert out.columns == ["id", "c", "x"] and out.first().x is None
    assert dict(out.dtypes)["x"] == "double"


LIMITS = pytest.mark.parametrize("inline, small", [(64, 10_000), (1, 10_000), (1, 2)])


def limit_levels(monkeypatch, inline, small):
    monkeypatch.setattr(fitted, "INLINE", inline)
    monkeypatch.setattr(fitted, "SMALL", small)


@LIMITS
def test_unseen_categories_become_null(spark, monkeypatch, inline, small):
    limit_levels(monkeypatch, inline, small)
    rows = [(i, "hot" if i % 3 else f"v{i % 20}", "u") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, c string, d string").repartition(4)
    model = V.MatchCategories(columns=["c", "d"]).fit(df)
    other = spark.createDataFrame([(1, "hot", "u"), (2, "nope", "w"), (3, "v3", None)], "id int, c string, d string")
    got = {r.id: (r.c, r.d) for r in model.transform(other).collect()}
    assert got == {1: ("hot", "u"), 2: (None, None), 3: ("v3", None)}
    assert model.transform(df).where("c is null").count() == 0


@LIMITS
def test_imputation_keeps_every_row(spark, monkeypatch, inline, small):
    """Also rows without an id, next to a column without any value and with names like the helper's."""
    limit_levels(monkeypatch, inline, small)
    rows = [(None if i % 50 == 0 else i, None if i % 3 else f"v{i % 90}", None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, c string, nothing string, value int").repartition(4)
    model = E.RandomSampleImpute(columns=["nothing", "c"], key="id", seed=25).fit(df)
    out = model.transform(df).collect()
    assert sorted(r.value for r in out) == list(range(900))
    assert all(r.c is not None and r.nothing is None for r in out)
    assert model.transform(df.limit(0)).count() == 0


@LIMITS
def test_saved_stages_take_their_levels_along(spark, monkeypatch, tmp_path, inline, small):
    limit_levels(monkeypatch, inline, small)
    root = tmp_path / "checkpoints"
    monkeypatch.setattr(fitted, "new_path", lambda spark, name: f"{root}/{name}")
    df = spark.createDataFrame([(i, None if i % 4 else f"v{i % 40}", float(i % 2)) for i in range(400)], "id int, c string, label double")
    stages = [
        V.MatchCategories(columns=["c"]).fit(df),
        E.RandomSampleImpute(columns=["c"], key="id").fit(df),
        E.TargetOrder(columns=["c"], label="label").fit(df),
    ]
    path, again = str(tmp_path / "saved"), str(tmp_path / "again")
    want = PipelineModel(stages).transform(df).collect()
    PipelineModel(stages).write().overwrite().save(path)
    root.rename(tmp_path / "gone")
    loaded = PipelineModel.load(path)
    assert sorted(loaded.transform(df).collect()) == sorted(want)
    loaded.write().overwrite().save(again)
    assert sorted(PipelineModel.load(again).transform(df).collect()) == sorted(want)


@LIMITS
def test_imputation_draws_observed_values_only(spark, monkeypatch, inline, small):
    limit_levels(monkeypatch, inline, small)
    rows = [(i, None if i % 2 else ("a" if i % 10 else "b" if i % 20 else "c")) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, c string")
    model = E.RandomSampleImpute(columns=["c"], key="id", seed=25).fit(df)
    out = {r.id: r.c for r in model.transform(df).collect()}
    assert len(out) == 4000
    assert all(out[i] == c for i, c in rows if c is not None)
    drawn = Counter(out[i] for i, c in rows if c is None)
    assert set(drawn) == {"a", "b", "c"}
    assert drawn["a"] / 2000 == pytest.approx(0.8, abs=0.04)
    assert out == {r.id: r.c for r in model.transform(df.repartition(3)).collect()}


def test_rare_labels(spark):
    rows = [("a", "x")] * 60 + [("b", "y")] * 36 + [("c", "y")] * 4 + [(None, None)] * 10
    df = spark.createDataFrame(rows, "p string, q string")
    model = E.RareLabels(columns=["p", "q"], tol=0.05, n_categories=2).fit(df)
    assert model.option("frequent") == {"p": ["a", "b"], "q": ["x", "y"]}
    out = model.transform(spark.createDataFrame([("c", "new"), (None, None), ("b", "x")], "p string, q string"))
    assert [tuple(r) for r in out.collect()] == [("Rare", "Rare"), (None, None), ("b", "x")]


def test_absent_columns_leave_the_frame_alone(spark):
    df = spark.createDataFrame([(1, 1.0)], "id int, label double")
    stages = [
        E.RandomSampleImpute(columns=["c"], key="id"),
        E.RareLabels(columns=["c"]),
        E.GeometricBins(columns=["c"]),
        E.TargetOrder(columns=["c"], label="label"),
        V.MatchCategories(skip=["id"]),
        V.DropQuasiConstant(columns=["c"]),
        V.DropCorrelated(columns=["c"]),
    ]
    for stage in stages:
        assert stage.fit(df).transform(df).collect() == df.collect()


def test_bins_are_closed_on_the_right(spark):
    edges = E.geometric_edges(0.0, 256.0, 8)
    assert edges == [2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0]
    df = spark.createDataFrame([(0.0,), (2.0,), (2.1,), (128.0,), (256.0,), (None,)], "x double")
    model = E.GeometricBins(columns=["x"], bins=8).fit(df)
    assert [r.x for r in model.transform(df).collect()] == [0, 0, 1, 6, 7, None]


@LIMITS
def test_codes_follow_the_target_mean(spark, monkeypatch, inline, small):
    limit_levels(monkeypatch, inline, small)
    rows = [("hi", 1.0), ("hi", 1.0), ("mid", 1.0), ("mid", 0.0), ("lo", 0.0), ("also_lo", 0.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "c string, label double")
    model = E.TargetOrder(columns=["c"], label="label").fit(df)
    other = spark.createDataFrame([(c,) for c in ["also_lo", "lo", "mid", "hi", "never", None]], "c string")
    assert sorted(r.c if r.c is not None else -1 for r in model.transform(other).collect()) == [-1, -1, 0, 1, 2, 3]


def scored_rows(spark, n=3000):
    rng = random.Random(2)
    rows = []
    for _ in range(n):
        label = int(rng.random() < 0.4)
        rows.append((round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * label, 0.2))), 2), label))
    return rows, spark.createDataFrame(rows, "score double, label int").repartition(6)


def test_auc_counts_ties_half(spark):
    rows, df = scored_rows(spark)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert M.roc_auc(df).first().auc == pytest.approx(brute)
    points = sorted((r.fpr, r.tpr) for r in M.roc_points(df).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and area == pytest.approx(brute)


def test_sweep_matches_direct_counts(spark):
    rows, df = scored_rows(spark, 500)
    sweep = {r.step: r for r in M.threshold_sweep(df).collect()}
    assert len(sweep) == 101
    for step, r in sweep.items():
        t = step * 0.01
        assert r.tp == sum(s >= t and y for s, y in rows) and r.fp == sum(s >= t and not y for s, y in rows)
    best = M.best_threshold(df).first()
    top = max(r.macro_f1 for r in sweep.values())
    assert best.step == min(s for s, r in sweep.items() if r.macro_f1 >= top - 1e-12)


def test_confusion_is_strict_and_report_is_not(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1), (0.5, 0), (0.1, 0)], "score double, label int")
    cells = M.confusion(df, 0.5).first()
    assert (cells.tp, cells.fp, cells.fn, cells.tn) == (1, 0, 1, 2)
    lines = {r.name: r for r in M.classification_report(df, 0.5).collect()}
    assert lines["1"].recall == 1.0 and lines["1"].precision == pytest.approx(2 / 3) and lines["accuracy"].f1 == 0.75
    assert M.log_loss(spark.createDataFrame([(0.0, 1)], "score double, label int")).first().log_loss > 30


def test_best_round_stops_after_patience():
    curve = [(0, 0.5), (1, 0.7), (2, 0.6), (3, 0.6), (4, 0.9)]
    assert T.best_round(curve) == 4
    assert T.best_round(curve, patience=2) == 1
    assert T.best_round([(0, 0.5), (1, 0.5)]) == 0


def entities(spark, n=600):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        used = rng.random() < 0.45
        rows.append((
            i, "used" if used else "new", rng.choice(["north", "south", "east", None]),
            rng.choice(["free", "gold"] if used else ["gold", "silver"]), bool(rng.random() < 0.5), rng.choice(["me2", "custom"]),
            int(rng.expovariate(1 / (5 if used else 40))) + 1, rng.random() * 100, f"title {i}", f"city {i % 9}", "g", "h", "k",
        ))
    return spark.createDataFrame(
        rows, "product_id int, condition string, state string, listing_type string, local_pickup boolean, shipping_mode string, "
        "stock_quantity bigint, total_amount double, title string, city string, attribute_group_id string, attribute_group string, attribute_id string",
    )


def test_training_flow_learns_and_survives_saving(spark, tmp_path):
    settings = replace(Settings(), boosting=replace(BoostingParams(), rounds=6, max_depth=3))
    flow = W.train_flow(entities(spark), "product_id", "condition", settings)
    assert "product_id" not in flow.features and "condition" not in flow.features and "title" not in flow.features
    metrics = {r.split: r for r in W.split_metrics(flow.scores).collect()}
    assert metrics["test"].auc > 0.7 and metrics["test"].positive_class == "used"

    path = str(tmp_path / "flow")
    PipelineModel([*flow.selection.stages, *flow.engineering.stages, *flow.model.stages]).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    raw = W.split_and_label(entities(spark), "product_id", "condition")
    again = {r.product_id: r.p1 for r in T.scored(loaded, raw).select("product_id", "p1").collect()}
    first = {r.product_id: r.p1 for r in flow.scores.select("product_id", "p1").collect()}
    assert again == pytest.approx(first)

    curve = T.learning_curve(flow.model, flow.matrix.where("split = 'test'"), ["split"])
    last = max(curve.collect(), key=lambda r: r["round"])
    assert last["round"] == 5 and last.auc == pytest.approx(metrics["test"].auc, abs=1e-3)
    assert last.log_loss == pytest.approx(metrics["test"].log_loss)

    # The first rounds alone score as the curve says.
    short = T.leading_trees(flow.model, 3)
    third = [r for r in curve.collect() if r["round"] == 2][0]
    tested = W.split_metrics(T.scored(short, flow.matrix.where("split = 'test'"))).first()
    assert len(T.booster_of(short).trees) == 3 and tested.log_loss == pytest.approx(third.log_loss)
    saved = str(tmp_path / "short")
    short.write().overwrite().save(saved)
    assert len(T.booster_of(PipelineModel.load(saved)).trees) == 3
    gains = T.importance(flow.model, spark).collect()
    assert sum(r.gain for r in gains) == pytest.approx(1.0)


def test_stopping_searching_and_folding_on_few_rounds(spark):
    settings = Settings()
    _, _, features, matrix = W.prepare_matrix(entities(spark, 300), "product_id", "condition", settings)
    few = replace(BoostingParams(), rounds=4, max_depth=2)
    model, curve = T.fit_with_early_stop(matrix, features, few, patience=2)
    best = T.best_round(curve, 2)
    assert len(curve) == 4 and len(T.booster_of(model).trees) == best + 1
    folds = T.cross_validate(matrix, features, few, "product_id", folds=2, patience=2).collect()
    assert len(folds) == 4 and sum(r.best for r in folds) == 1
    tried = T.search_boosting(matrix, features, replace(few, rounds=2), trials=2).collect()
    assert len(tried) == 2 and tried[0].auc >= tried[1].auc


def test_metrics_by_weight(spark):
    rng = random.Random(4)
    rows = [(rng.random(), int(rng.random() < 0.5), rng.choice([0.25, 1.0, 3.0])) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, label int, weight double")
    pos, neg = [(s, w) for s, y, w in rows if y], [(s, w) for s, y, w in rows if not y]
    area = sum(a * b * ((p > q) + 0.5 * (p == q)) for p, a in pos for q, b in neg) / (sum(w for _, w in pos) * sum(w for _, w in neg))
    assert M.roc_auc(df, weight="weight").first().auc == pytest.approx(area)
    loss = sum(-w * math.log(s if y else 1 - s) for s, y, w in rows) / sum(w for *_, w in rows)
    assert M.log_loss(df, weight="weight").first().log_loss == pytest.approx(loss)


def test_too_many_classes_are_refused(spark):
    with pytest.raises(ValueError):
        L.EncodeLabel(target="id").fit(spark.range(2000))


def test_rows_without_an_id_keep_the_split_exact(spark):
    df = classes(spark, {"new": 100, "used": 50}).withColumn("id", F.when(F.col("id") != 7, F.col("id")))
    found = Counter(r.split for r in L.StratifiedSplit(target="target", key="id", seed=1).fit(df).transform(df).collect())
    assert found == {"train": 90, "val": 30, "test": 30}


def test_written_tables_can_be_deleted(spark):
    path = store.new_path(spark, "some")
    spark.range(3).write.parquet(path)
    assert store.cleanup(spark) >= 1 and store.cleanup(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    T.log_run(spark, path, "one", {"a": 1}, {"auc": 0.5})
    T.log_run(spark, path, "two", {"a": 2}, {"auc": 0.6, "log_loss": 0.4})
    assert spark.read.parquet(path).count() == 3
