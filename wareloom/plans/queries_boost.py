"""Second-order boosting: scores, gains, stopping, folds and both searches, as facts that a wrong model breaks."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.operators import boost as B
from wareloom.operators import search as S
from wareloom.operators.evaluate import roc_auc
from wareloom.operators.split import StratifiedFolds
from wareloom.operators.train import with_weight
from wareloom.plans import training as W
from wareloom.plans.feature_search import search_features
from wareloom.plans.queries_model import KEY, SPLIT_SQL, TARGET, matrix, products, with_products
from wareloom.plans.registry import query
from wareloom.sources.store import materialize, new_path

PATIENCE = 25
FOLDS, FOLD_PATIENCE = 10, 10
TRIALS = 50
#: Scores are counted in steps of 1 / 10000, those within a step as tied.
AUC_STEP = 1e-3

_GROWN: dict = {}


def learned(spark, sf_dir) -> DataFrame:
    """Training and validation rows with their weight."""
    return with_weight(matrix(spark, sf_dir)[0].where(F.col("split").isin("train", "val")))


def grown(spark, sf_dir) -> B.BoostedTrees:
    """The tuned model over training and validation rows, grown once per session and data folder."""
    name = spark.sparkContext.applicationId, sf_dir
    if name not in _GROWN:
        _GROWN[name] = B.fit(learned(spark, sf_dir), matrix(spark, sf_dir)[1], B.TreeParams(), KEY)
    return _GROWN[name]


def node_table(spark, model: B.BoostedTrees) -> DataFrame:
    """One row per node of each tree."""
    names = model.features()
    rows = [
        (k, n, names[f] if f >= 0 else None, float(model.option("cuts")[f][b - 1]) if 0 <= f and b - 1 < len(model.option("cuts")[f]) else math.inf, m, left, right, v)
        for k, t in enumerate(model.trees())
        for n, (f, b, m, left, right, v) in enumerate(zip(t.feature, t.bin, t.missing_left, t.left, t.right, t.value))
    ]
    return spark.createDataFrame(rows, "tree int, node int, feature string, edge double, missing_left boolean, left int, right int, value double")


def walked(rows: DataFrame, model: B.BoostedTrees, depth: int) -> DataFrame:
    """(key, margin) by walking every tree with joins: a value below a node's edge goes left, a missing one its default way."""
    nodes = F.broadcast(node_table(rows.sparkSession, model))
    values = F.create_map(*[x for c in model.features() for x in (F.lit(c), F.col(c).cast("double"))])
    at = rows.select(KEY, values.alias("values"), F.explode(F.sequence(F.lit(0), F.lit(len(model.trees()) - 1))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        value = F.col("values")[F.col("feature")]
        left = F.when(value.isNull(), F.col("missing_left")).otherwise(value < F.col("edge"))
        step = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.when(left, F.col("left")).otherwise(F.col("right")))
        at = at.join(nodes.drop("value"), ["tree", "node"]).select(KEY, "values", "tree", step.alias("node"))
    return at.join(nodes, ["tree", "node"]).groupBy(KEY).agg(F.sum("value").alias("walked"))


def probability(margin: str = "margin"):
    return 1 / (1 + F.exp(-F.col(margin)))


@query(
    "m1_second_order_scores",
    with_products(
        "SELECT split, count(*) AS n, 93 AS rounds, true AS equals_walked_trees, true AS equals_saved, true AS near_training_area "
        "FROM parted GROUP BY split",
        SPLIT_SQL,
    ),
)
def _scores(spark, sf_dir):
    """Scores against trees walked by joins and against the saved model; areas per split within 0.15 of the training rows'."""
    rows, _ = matrix(spark, sf_dir)
    model = grown(spark, sf_dir)
    path = new_path(spark, "trees")
    model.save(path)
    saved = B.BoostedTrees.load(path).transform(rows).select(KEY, F.col("margin").alias("again"))
    scored = materialize(model.transform(rows).join(saved, KEY).join(walked(rows, model, B.TreeParams().max_depth), KEY), "scored")
    areas = roc_auc(scored.withColumn("p1", probability()), "p1", "label", ["split"])
    near = areas.withColumn("train_auc", F.lit(areas.where("split = 'train'").first().auc))
    facts = scored.groupBy("split").agg(
        F.count("*").alias("n"),
        F.bool_and(F.abs(F.col("margin") - F.col("walked")) < 1e-9).alias("equals_walked_trees"),
        F.bool_and(F.col("margin") == F.col("again")).alias("equals_saved"),
    )
    return facts.join(near, "split").select(
        "split",
        "n",
        F.lit(len(model.trees())).alias("rounds"),
        "equals_walked_trees",
        "equals_saved",
        (F.abs(F.col("auc") - F.col("train_auc")) < 0.15).alias("near_training_area"),
    )


@query(
    "m9_average_gain",
    "SELECT 0::bigint AS n_unknown, true AS sorted, true AS means_of_splits, true AS all_gain, true AS covers_kept FROM region LIMIT 1",
)
def _gain(spark, sf_dir):
    """Mean gain per split of each column against the splits of the trees; every split gains and keeps the hessian minimum."""
    model, features = grown(spark, sf_dir), matrix(spark, sf_dir)[1]
    gains = B.importance(model, spark)
    nodes = spark.createDataFrame(
        [(model.features()[f], g, t.cover[a], t.cover[b]) for t in model.trees() for f, g, a, b in zip(t.feature, t.gain, t.left, t.right) if f >= 0],
        "feature string, g double, left_cover double, right_cover double",
    )
    again = nodes.groupBy("feature").agg(F.avg("g").alias("mean"), F.count("*").alias("n"))
    order = [r.gain for r in gains.collect()]
    least = B.TreeParams().min_child_weight
    kept = nodes.agg(
        F.bool_and(F.col("g") > 0).alias("all_gain"),
        F.bool_and((F.col("left_cover") >= least) & (F.col("right_cover") >= least)).alias("covers_kept"),
    ).first()
    both = gains.join(again, "feature", "full")
    return both.agg(
        F.count_if(~F.col("feature").isin(features)).alias("n_unknown"),
        F.lit(order == sorted(order, reverse=True)).alias("sorted"),
        F.bool_and((F.abs(F.col("gain") - F.col("mean")) < 1e-9) & (F.col("splits") == F.col("n"))).alias("means_of_splits"),
        F.lit(kept.all_gain).alias("all_gain"),
        F.lit(kept.covers_kept).alias("covers_kept"),
    )


@query(
    "m11_stopped_training",
    with_products(
        "SELECT split, count(*) AS n, true AS none_past_patience, true AS kept_up_to_best, true AS area_matches FROM parted GROUP BY split",
        SPLIT_SQL,
    ),
)
def _stopped(spark, sf_dir):
    """No tree was grown past the patience, the model ends at the best round, and its area is the one that was watched."""
    rows, features = matrix(spark, sf_dir)
    model, state = B.fit_until_worse(learned(spark, sf_dir), features, B.TreeParams(), KEY, F.col("split") == "val", PATIENCE)
    areas = [a for a, _ in state.members[0].curve]
    best, trees = B.best_of(areas), len(state.members[0].trees)
    scored = model.transform(rows).withColumn("p1", probability())
    # Weights are the same within a class, so the area does not depend on them.
    auc = roc_auc(scored.where("split = 'val'"), "p1", "label").first().auc
    return scored.groupBy("split").agg(F.count("*").alias("n")).select(
        "split",
        "n",
        F.lit(trees == min(best + 1 + PATIENCE, B.TreeParams().rounds) == len(areas)).alias("none_past_patience"),
        F.lit(len(model.trees()) == best + 1).alias("kept_up_to_best"),
        F.lit(abs(auc - areas[best]) < AUC_STEP).alias("area_matches"),
    )


FOLD_SQL = (
    "folded AS (SELECT product_id, (SELECT count(*) FROM range(1, 10) f(i) WHERE place > n * i // 10)::int AS fold FROM "
    "(SELECT product_id, count(*) OVER (PARTITION BY condition) AS n, row_number() OVER "
    "(PARTITION BY condition ORDER BY md5('25:' || product_id::varchar)) AS place FROM parted WHERE split IN ('train', 'val')))"
)


@query(
    "m10_cross_validation",
    with_products(
        "SELECT fold, count(*) AS n, true AS area_matches, true AS none_past_patience, true AS scans_shared, true AS better_than_chance "
        "FROM folded GROUP BY fold",
        SPLIT_SQL,
        FOLD_SQL,
    ),
)
def _cross_validation(spark, sf_dir):
    """Ten folds in shared scans: each fold's area at the best round against its model's scores of the rows left out."""
    rows, features = learned(spark, sf_dir), matrix(spark, sf_dir)[1]
    folded = StratifiedFolds(target="label", key=KEY, folds=FOLDS, seed=25).fit(rows).transform(rows)
    folded = materialize(folded.select(KEY, "label", "weight", "fold", *features), "folds")
    params = B.TreeParams()
    means, state = B.cross_validate(folded, features, params, KEY, folds=FOLDS, patience=FOLD_PATIENCE)
    best = B.best_of([r["auc"] for r in means])
    cuts = B.fit_cuts(folded, features)
    parts = []
    for k, member in enumerate(state.members):
        model = B.model_of(member, features, cuts, best + 1)
        parts.append(model.transform(folded.where(F.col("fold") == k)).select("fold", "label", "weight", probability().alias("p1")))
    scored = materialize(reduce(DataFrame.unionByName, parts), "fold-scores")
    watched = spark.createDataFrame([(k, m.curve[best][0]) for k, m in enumerate(state.members)], "fold int, watched double")
    areas = roc_auc(scored, "p1", "label", ["fold"], "weight").join(watched, "fold")
    stopped_in_time = all(len(m.trees) == len(means) == min(best + 1 + FOLD_PATIENCE, params.rounds) for m in state.members)
    return scored.groupBy("fold").agg(F.count("*").alias("n")).join(areas, "fold").select(
        "fold",
        "n",
        (F.abs(F.col("auc") - F.col("watched")) < AUC_STEP).alias("area_matches"),
        F.lit(stopped_in_time).alias("none_past_patience"),
        F.lit(state.scans <= len(means) * params.max_depth + 1).alias("scans_shared"),
        (F.col("auc") > 0.5).alias("better_than_chance"),
    )


@query(
    "m12_engineering_search",
    f"SELECT {TRIALS}::bigint AS n_trials, true AS in_ranges, true AS alike_score_alike, true AS stages_shared, true AS best_first, "
    "true AS better_than_chance FROM region LIMIT 1",
)
def _engineering_search(spark, sf_dir):
    """Fifty trials of rare-level and bin settings over ten folds; stages and matrices that come out alike are shared."""
    labelled = W.split_and_label(products(spark, sf_dir), KEY, TARGET)
    _, selected = W.fit_on_train(W.selection_pipeline(W.training_rows(labelled), KEY, TARGET), labelled)
    found = search_features(materialize(selected, "selected"), KEY, TARGET, trials=TRIALS)
    trials = found.table(spark)
    areas = [r.auc for r in trials.collect()]
    scores = trials.groupBy("matrix").agg(F.count_distinct("auc").alias("n"))
    return trials.agg(
        F.count("*").alias("n_trials"),
        F.bool_and(F.col("n_cat_high").between(2, 5) & F.col("n_cat_low").between(2, 5) & F.col("bins").between(5, 10)).alias("in_ranges"),
        F.lit(scores.where("n > 1").isEmpty()).alias("alike_score_alike"),
        F.lit(found.trie.fits < found.trie.asked / 2).alias("stages_shared"),
        F.lit(areas == sorted(areas, reverse=True)).alias("best_first"),
        F.lit(areas[0] > 0.5).alias("better_than_chance"),
    )


#: Rounds after which the trials of a generation are compared; the search itself goes up to 1000.
SEARCH_ROUNDS, SEARCH_LEAST, SEARCH_AT_ONCE = 81, 3, 25


@query(
    "m13_boosting_search",
    "SELECT trial::int AS trial, true AS in_ranges, true AS budget_kept, true AS share_kept, true AS best_matches "
    f"FROM range({TRIALS}) t(trial)",
)
def _boosting_search(spark, sf_dir):
    """Fifty trials in generations: a third goes on after each budget, and the best area is that of the best model's scores."""
    rows, features = matrix(spark, sf_dir)
    trials, model = S.search_boosting(
        rows, features, KEY, trials=TRIALS, at_once=SEARCH_AT_ONCE, rounds=SEARCH_ROUNDS, least_rounds=SEARCH_LEAST
    )
    best = roc_auc(model.transform(rows.where("split = 'val'")).withColumn("p1", probability()), "p1", "label").first().auc
    table = S.trial_table(spark, trials).withColumn("generation", F.floor(F.col("trial") / SEARCH_AT_ONCE))
    params = F.from_json("params", ", ".join(f"{name} double" for name in S.BOOSTING_SPACE))
    inside = [params[name].between(d.low, d.high) for name, d in S.BOOSTING_SPACE.items()]
    last = F.element_at("rungs", -1)
    # A trial ends at the budget of its last rung, or earlier when its area has not risen.
    kept = F.when(F.col("ended") == "patience", F.col("rounds") <= last).otherwise(F.col("rounds") == last)
    reached = table.select("generation", F.explode("rungs").alias("budget")).groupBy("generation", "budget").count().collect()
    steps = S.budgets(SEARCH_LEAST, SEARCH_ROUNDS, 3)
    counts = {(r.generation, steps.index(r.budget)): r["count"] for r in reached}
    share = all(n <= math.ceil(counts[g, place - 1] / 3) for (g, place), n in counts.items() if place)
    return table.select(
        "trial",
        reduce(lambda x, y: x & y, inside).alias("in_ranges"),
        kept.alias("budget_kept"),
        F.lit(share).alias("share_kept"),
        F.lit(abs(best - trials[0].value) < AUC_STEP).alias("best_matches"),
    )
