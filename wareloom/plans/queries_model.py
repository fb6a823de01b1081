"""Split, selection, engineering, evaluation, training and persistence."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from wareloom.operators import engineer as E
from wareloom.operators import evaluate as M
from wareloom.operators import select as V
from wareloom.operators import split as L
from wareloom.operators import train as T
from wareloom.operators.clean import FlagsToText
from wareloom.operators.entity import entity_aggregate
from wareloom.operators.ranks import running_totals
from wareloom.operators.steps import Step
from wareloom.plans import training as W
from wareloom.plans.driver_tables import listing_rows, table
from wareloom.plans.registry import query, rounded
from wareloom.plans.sql_texts import entity_part, with_listing
from wareloom.settings import BoostingParams, Settings
from wareloom.sources.store import materialize, new_path

KEY, TARGET = "product_id", "condition"

def products(spark, sf_dir, modes=None):
    """The stored product table, written once for the many fits that follow."""
    rows = entity_aggregate(listing_rows(spark, sf_dir), KEY, ordered=False, modes=modes)
    return materialize(rows, "products")


PRODUCTS_SQL = entity_part(KEY)


def with_products(body: str, *parts: str) -> str:
    return with_listing(body, PRODUCTS_SQL, *parts)


# Largest-remainder allocation of a total over the classes of a size table.
def allocate_sql(name: str, sizes: str, total: str) -> str:
    return f"""{name} AS (SELECT condition, floor(exact)::bigint
      + (row_number() OVER (ORDER BY exact - floor(exact) DESC, n DESC, condition) <= total - sum(floor(exact)) OVER ())::int AS take
      FROM (SELECT condition, n, t.total, t.total * n / sum(n) OVER () AS exact FROM {sizes}, ({total}) t(total)))"""


SPLIT_SQL = ",\n".join(
    [
        "sizes AS (SELECT condition, count(*) AS n FROM entity GROUP BY 1)",
        allocate_sql("train_size", "sizes", "SELECT sum(n) - ceil(sum(n) * 0.4) FROM sizes"),
        "held AS (SELECT condition, n - take AS n FROM sizes JOIN train_size USING (condition))",
        allocate_sql("val_size", "held", "SELECT sum(n) - ceil(sum(n) * 0.5) FROM held"),
        """parted AS (SELECT product_id, condition, CASE WHEN place <= t.take THEN 'train' WHEN place <= t.take + v.take THEN 'val'
          ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY md5('25:' || product_id::varchar))
          AS place FROM entity) e JOIN train_size t USING (condition) JOIN val_size v USING (condition))""",
    ]
)


@query("l1_stratified_split", with_products("SELECT product_id, condition, split FROM parted", SPLIT_SQL))
def _split(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET]).select(KEY, TARGET)
    return L.StratifiedSplit(target=TARGET, key=KEY, seed=25).fit(rows).transform(rows)


@query(
    "l2_label",
    with_products("SELECT product_id, CASE condition WHEN 'new' THEN 0.0 WHEN 'used' THEN 1.0 END::double AS label FROM entity"),
)
def _label(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET]).select(KEY, TARGET)
    return L.EncodeLabel(target=TARGET).fit(rows).transform(rows).select(KEY, "label")


@query(
    "l3_class_weight",
    with_products(
        "SELECT product_id, round(count(*) OVER (PARTITION BY condition) / count(*) OVER (), 4) AS weight FROM entity"
    ),
)
def _weight(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET]).select(KEY, TARGET)
    labelled = L.EncodeLabel(target=TARGET).fit(rows).transform(rows)
    return rounded(L.ClassWeights().fit(labelled).transform(labelled).select(KEY, "weight"))


@query(
    "u2_train_and_validation",
    with_products("SELECT split, count(*) AS n FROM parted WHERE split IN ('train', 'val') GROUP BY 1", SPLIT_SQL),
)
def _train_val(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET]).select(KEY, TARGET)
    parted = L.StratifiedSplit(target=TARGET, key=KEY, seed=25).fit(rows).transform(rows)
    return parted.where(F.col("split").isin("train", "val")).groupBy("split").agg(F.count("*").alias("n"))


@query(
    "m10_stratified_folds",
    with_products(
        "SELECT product_id, (SELECT count(*) FROM range(1, 10) f(i) WHERE place > n * i // 10)::int AS fold FROM "
        "(SELECT product_id, count(*) OVER (PARTITION BY condition) AS n, row_number() OVER "
        "(PARTITION BY condition ORDER BY md5('25:' || product_id::varchar)) AS place FROM entity)"
    ),
)
def _folds(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET]).select(KEY, TARGET)
    folded = L.StratifiedFolds(target=TARGET, key=KEY, folds=10, seed=25).fit(rows).transform(rows)
    return folded.select(KEY, "fold")


# --- selection ----------------------------------------------------------------

WATCHED = ["condition", "local_pickup", "free_shipping", "shipping_mode", "status", "currency", "state", "attribute_id"]


@query(
    "v1_configured_columns",
    with_products("SELECT product_id, condition, state, listing_type FROM entity"),
)
def _configured(spark, sf_dir):
    lists = Settings().selection
    dropped = [*lists.categoricals_more_than_threshold, *lists.high_cardinality_from_eda]
    rows = V.DropColumns(columns=dropped, strict=True).transform(products(spark, sf_dir))
    return rows.select(*[c for c in rows.columns if c in (KEY, TARGET, "state", "listing_type", *dropped)])


MODAL_SHARE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(coalesce(max(n) FILTER ({c} IS NOT NULL), 0) / sum(n), 10) AS share "
    f"FROM (SELECT {c}, count(*) AS n FROM entity GROUP BY 1)"
    for c in WATCHED
)


@query("v2_modal_shares", with_products(MODAL_SHARE_SQL))
def _modal_shares(spark, sf_dir):
    return rounded(V.modal_shares(products(spark, sf_dir, WATCHED), WATCHED), 10)


@query(
    "v2_quasi_constant",
    with_products(f"SELECT variable AS column_name FROM ({MODAL_SHARE_SQL}) WHERE share >= 0.95"),
)
def _quasi_constant(spark, sf_dir):
    fitted = V.DropQuasiConstant(columns=WATCHED, tol=0.95).fit(products(spark, sf_dir, WATCHED))
    return spark.createDataFrame([(c,) for c in fitted.option("columns")], "column_name string")


@query(
    "v3_matched_columns",
    with_products("SELECT product_id, state, NULL::varchar AS listing_type FROM entity"),
)
def _matched(spark, sf_dir):
    rows = products(spark, sf_dir)
    fitted = V.MatchColumns(keep=[KEY]).fit(rows.select(KEY, "state", "listing_type"))
    return fitted.transform(rows.select(KEY, "title", "state"))


@query(
    "v4_correlated_columns",
    with_products(
        "SELECT 'stock_quantity' AS column_name FROM twice HAVING abs(corr(available_quantity, stock_quantity)) > 0.8 "
        "UNION ALL SELECT 'total_amount_twice' FROM twice HAVING abs(corr(total_amount, total_amount_twice)) > 0.8",
        "twice AS (SELECT *, 2 * total_amount + 1 AS total_amount_twice FROM entity)",
    ),
)
def _correlated(spark, sf_dir):
    rows = products(spark, sf_dir, []).withColumn("total_amount_twice", 2 * F.col("total_amount") + 1)
    columns = ["total_amount_twice", "total_amount", "stock_quantity", "available_quantity"]
    fitted = V.DropCorrelated(columns=columns, threshold=0.8).fit(rows)
    return spark.createDataFrame([(c,) for c in fitted.option("columns")], "column_name string")


@query(
    "v5_matched_categories",
    with_products(
        "SELECT product_id, CASE WHEN attribute_id IN (SELECT e.attribute_id FROM entity e JOIN parted p USING (product_id) "
        "WHERE p.split = 'train') THEN attribute_id END AS attribute_id FROM entity",
        SPLIT_SQL,
    ),
)
def _matched_categories(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET, "attribute_id"]).select(KEY, TARGET, "attribute_id")
    parted = L.StratifiedSplit(target=TARGET, key=KEY, seed=25).fit(rows).transform(rows)
    fitted = V.MatchCategories(columns=["attribute_id"]).fit(W.training_rows(parted))
    return fitted.transform(parted).select(KEY, "attribute_id")


@query(
    "c12_aligned_categories",
    with_products(
        "SELECT product_id, "
        + ", ".join(
            f"CASE WHEN {c} IN (SELECT e.{c} FROM entity e JOIN parted p USING (product_id) WHERE p.split = 'train') THEN {c} END AS {c}"
            for c in ["attribute_id", "listing_type"]
        )
        + " FROM entity",
        SPLIT_SQL,
    ),
)
def _aligned_categories(spark, sf_dir):
    columns = ["attribute_id", "listing_type"]
    rows = products(spark, sf_dir, [TARGET, *columns]).select(KEY, TARGET, *columns)
    parted = L.StratifiedSplit(target=TARGET, key=KEY, seed=25).fit(rows).transform(rows)
    fitted = V.MatchCategories(columns=columns).fit(W.training_rows(parted))
    return fitted.transform(parted).select(KEY, *columns)


# Which columns of the product table selection keeps, stated column by column.
SELECT_TEXT = ["state", "shipping_mode", "listing_type", "buying_mode", "status", "currency"]
SELECT_FLAGS = ["local_pickup", "free_shipping", "accepts_mercadopago", "automatic_relist"]
SELECT_NUMBERS = ["available_quantity", "date_difference_hr", "stock_quantity", "time_difference_hr", "total_amount"]


def _kept_sql() -> list[str]:
    """CTEs ending in ``kept``: one row of flags ``k_<column>``."""
    shares = ", ".join(
        f"(SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM train_rows WHERE {c} IS NOT NULL GROUP BY {c})) "
        f"/ (SELECT count(*) FROM train_rows) >= 0.95 AS q_{c}"
        for c in SELECT_TEXT + SELECT_FLAGS + SELECT_NUMBERS
    )
    kinds = ", ".join(
        f"(SELECT count(DISTINCT {c}) + max(({c} IS NULL)::int) > 5 FROM train_rows) AS c_{c}" for c in SELECT_NUMBERS
    )
    strong = ", ".join(
        f"(SELECT coalesce(abs(corr({a}, {b})) > 0.8, false) FROM train_rows) AS s_{a}_{b}"
        for i, a in enumerate(SELECT_NUMBERS)
        for b in SELECT_NUMBERS[i + 1 :]
    )
    steps, source = [], "decisions"
    for i, c in enumerate(SELECT_NUMBERS):
        # Numbers with few values are neither watched nor compared.
        hit = " OR ".join(f"(k_{a} AND c_{a} AND s_{a}_{c})" for a in SELECT_NUMBERS[:i]) or "false"
        steps.append(f"step_{i} AS (SELECT *, NOT c_{c} OR (NOT q_{c} AND NOT ({hit})) AS k_{c} FROM {source})")
        source = f"step_{i}"
    others = ", ".join(f"NOT q_{c} AS k_{c}" for c in SELECT_TEXT + SELECT_FLAGS)
    return [
        "train_rows AS (SELECT e.* FROM entity e JOIN parted p USING (product_id) WHERE p.split = 'train')",
        f"decisions AS (SELECT {shares}, {kinds}, {strong})",
        *steps,
        f"kept AS (SELECT *, {others} FROM {source})",
    ]


KEPT_SQL = _kept_sql()
LABEL_SQL = "(condition = 'used')::int::double AS label"


def known_sql(c: str) -> str:
    """A text value as it is after unseen ones became null."""
    return f"CASE WHEN {c} IN (SELECT {c} FROM train_rows) THEN {c} END"


def long_form(rows):
    """(product_id, split, label, variable, text, number): one row per cell, whatever columns are left."""
    cells = []
    for f in rows.schema.fields:
        if f.name in (KEY, TARGET, "split", "label"):
            continue
        number = isinstance(f.dataType, (DoubleType, LongType, IntegerType))
        cells.append(
            F.struct(
                F.lit(f.name).alias("variable"),
                (F.lit(None) if number else F.col(f.name)).cast("string").alias("text"),
                F.round((F.col(f.name) if number else F.lit(None)).cast("double"), 4).alias("number"),
            )
        )
    return rows.select(KEY, "split", "label", F.inline(F.array(*cells)))


V6_SQL = " UNION ALL ".join(
    [
        f"SELECT product_id, split, {LABEL_SQL}, '{c}' AS variable, ({known_sql(c) if c in SELECT_TEXT else c})::varchar AS text, "
        f"NULL::double AS number FROM entity JOIN parted USING (product_id, condition), kept WHERE k_{c}"
        for c in SELECT_TEXT + SELECT_FLAGS
    ]
    + [
        f"SELECT product_id, split, {LABEL_SQL}, '{c}', NULL, round({c}::double, 4) "
        f"FROM entity JOIN parted USING (product_id, condition), kept WHERE k_{c}"
        for c in SELECT_NUMBERS
    ]
)


@query("v6_selection", with_products(V6_SQL, SPLIT_SQL, *KEPT_SQL))
def _selection(spark, sf_dir):
    labelled = W.split_and_label(products(spark, sf_dir), KEY, TARGET)
    pipeline = W.selection_pipeline(W.training_rows(labelled), KEY, TARGET)
    return long_form(W.fit_on_train(pipeline, labelled)[1])


# --- engineering --------------------------------------------------------------


@query(
    "e1_random_sample_imputation",
    with_products(
        """SELECT product_id, coalesce(attribute_group, drawn) AS attribute_group FROM
        (SELECT product_id, attribute_group, (SELECT min(value) FROM shares WHERE u < high) AS drawn FROM
          (SELECT *, ('0x' || substr(md5('25:attribute_group:' || product_id::varchar), 1, 13))::bigint / pow(16, 13) AS u FROM entity))""",
        """shares AS (SELECT attribute_group AS value, sum(count(*)) OVER (ORDER BY attribute_group) / sum(count(*)) OVER () AS high
          FROM entity WHERE attribute_group IS NOT NULL GROUP BY 1)""",
    ),
)
def _imputed(spark, sf_dir):
    rows = products(spark, sf_dir, ["attribute_group"]).select(KEY, "attribute_group")
    fitted = E.RandomSampleImpute(columns=["attribute_group"], key=KEY, seed=25).fit(rows)
    return fitted.transform(rows)


@query(
    "e1_imputation_many_levels",
    with_products(
        """SELECT id, coalesce(attribute_id, drawn) AS attribute_id, nothing FROM
        (SELECT id, attribute_id, nothing, (SELECT min(value) FROM shares WHERE u < high) AS drawn FROM
          (SELECT *, ('0x' || substr(md5('25:attribute_id:' || coalesce(id::varchar, '')), 1, 13))::bigint / pow(16, 13) AS u FROM holes))""",
        """holes AS (SELECT CASE WHEN product_id % 50 <> 7 THEN product_id END AS id, attribute_id, NULL::varchar AS nothing FROM entity)""",
        """shares AS (SELECT attribute_id AS value, sum(count(*)) OVER (ORDER BY attribute_id) / sum(count(*)) OVER () AS high
          FROM holes WHERE attribute_id IS NOT NULL GROUP BY 1)""",
    ),
)
def _imputed_many(spark, sf_dir):
    """Many levels, a column without any value and rows without an id."""
    rows = products(spark, sf_dir, ["attribute_id"]).select(
        F.when(F.col(KEY) % 50 != 7, F.col(KEY)).alias("id"), "attribute_id", F.lit(None).cast("string").alias("nothing")
    )
    fitted = E.RandomSampleImpute(columns=["attribute_id", "nothing"], key="id", seed=25).fit(rows)
    return fitted.transform(rows)


def rare_sql(c: str, few: int, source: str = "entity") -> str:
    return (
        f"CASE WHEN {c} IS NULL OR (SELECT count(DISTINCT {c}) FROM {source}) <= {few} OR {c}::varchar IN "
        f"(SELECT {c}::varchar FROM {source} GROUP BY {c} HAVING count(*) / (SELECT count({c}) FROM {source}) >= 0.05) "
        f"THEN {c}::varchar ELSE 'Rare' END"
    )


@query(
    "e2_rare_labels",
    with_products(
        f"SELECT product_id, {rare_sql('state', 2)} AS state, {rare_sql('listing_type', 2)} AS listing_type, "
        f"{rare_sql('local_pickup', 2)} AS local_pickup FROM entity"
    ),
)
def _rare(spark, sf_dir):
    columns = ["state", "listing_type", "local_pickup"]
    rows = products(spark, sf_dir, columns).select(KEY, *columns)
    return E.RareLabels(columns=columns, tol=0.05, n_categories=2).fit(rows).transform(rows)


BINNED = ["stock_quantity", "total_amount", "date_difference_hr"]


def binned_sql(c: str, source: str) -> str:
    edges = f"(SELECT list(round(low + pow(pow(high - low, 1.0 / 8), i), 7)) FROM range(1, 8) g(i), "
    edges += f"(SELECT min({c})::double AS low, max({c})::double AS high FROM {source}))"
    return f"CASE WHEN {c} IS NOT NULL THEN len(list_filter({edges}, lambda e: {c} > e))::int END"


@query(
    "e3_geometric_bins",
    with_products("SELECT product_id, " + ", ".join(f"{binned_sql(c, 'entity')} AS {c}" for c in BINNED) + " FROM entity"),
)
def _binned(spark, sf_dir):
    rows = products(spark, sf_dir, []).select(KEY, *BINNED)
    return E.GeometricBins(columns=BINNED, bins=8).fit(rows).transform(rows)


CODED = ["state", "listing_type", "attribute_id"]


def code_sql(c: str, source: str, label: str = "label") -> str:
    return (
        f"SELECT '{c}' AS variable, {c}::varchar AS value, count(*) AS n, round(avg({label}), 4) AS mean_label, "
        f"(row_number() OVER (ORDER BY avg({label}), {c}::varchar) - 1)::double AS code "
        f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
    )


LABELLED_SQL = "labelled AS (SELECT *, (condition = 'used')::int::double AS label FROM entity)"


def labelled(spark, sf_dir):
    return products(spark, sf_dir, [TARGET, *CODED]).withColumn("label", (F.col(TARGET) == "used").cast("double"))


@query("e4_ordered_codes", with_products(" UNION ALL ".join(code_sql(c, "labelled") for c in CODED), LABELLED_SQL))
def _codes(spark, sf_dir):
    return rounded(E.ordered_codes(labelled(spark, sf_dir), CODED, "label"))


@query(
    "e4_encoded_columns",
    with_products(
        "SELECT product_id, "
        + ", ".join(f"(SELECT code FROM c_{c} WHERE value = {c}) AS {c}" for c in CODED)
        + " FROM labelled",
        LABELLED_SQL,
        *[f"c_{c} AS ({code_sql(c, 'labelled')})" for c in CODED],
    ),
)
def _encoded(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return E.TargetOrder(columns=CODED, label="label").fit(rows).transform(rows).select(KEY, *CODED)


CHAIN = ["state", "listing_type", "stock_quantity"]
CHAIN_SQL = [
    SPLIT_SQL,
    "base AS (SELECT e.product_id, state, listing_type, stock_quantity, split, (e.condition = 'used')::int::double AS label, "
    "('0x' || substr(md5('25:state:' || e.product_id::varchar), 1, 13))::bigint / pow(16, 13) AS u "
    "FROM entity e JOIN parted p USING (product_id))",
    "shares AS (SELECT state AS value, sum(count(*)) OVER (ORDER BY state) / sum(count(*)) OVER () AS high "
    "FROM base WHERE split = 'train' AND state IS NOT NULL GROUP BY 1)",
    "filled AS (SELECT * EXCLUDE (state), coalesce(state, (SELECT min(value) FROM shares WHERE u < high)) AS state FROM base)",
    "filled_train AS (SELECT * FROM filled WHERE split = 'train')",
    f"grouped AS (SELECT product_id, split, label, {rare_sql('state', 2, 'filled_train')} AS state, "
    f"{rare_sql('listing_type', 2, 'filled_train')} AS listing_type, "
    f"{binned_sql('stock_quantity', 'filled_train')}::varchar AS stock_quantity FROM filled)",
    "grouped_train AS (SELECT * FROM grouped WHERE split = 'train')",
    *[f"codes_{c} AS ({code_sql(c, 'grouped_train')})" for c in CHAIN],
]


@query(
    "e5_engineering_chain",
    with_products(
        "SELECT product_id, split, "
        + ", ".join(f"(SELECT code FROM codes_{c} WHERE value = {c}) AS {c}" for c in CHAIN)
        + " FROM grouped",
        *CHAIN_SQL,
    ),
)
def _chain(spark, sf_dir):
    rows = products(spark, sf_dir, [TARGET, "state", "listing_type"]).select(KEY, TARGET, *CHAIN)
    labelled_rows = W.split_and_label(rows, KEY, TARGET)
    pipeline, _ = W.engineering_pipeline(W.training_rows(labelled_rows), KEY, TARGET)
    return W.fit_on_train(pipeline, labelled_rows)[1].select(KEY, "split", *CHAIN)


RARE = ["state", "listing_type", "local_pickup", "shipping_mode"]


def _matrix_sql() -> list[str]:
    """CTEs of the whole chain over every column that selection may keep, ending in one table of codes each."""
    drawn = "coalesce({known}, (SELECT min(value) FROM state_shares WHERE u < high))".format(known=known_sql("state"))
    texts = ", ".join(f"({known_sql(c)}) AS {c}" for c in SELECT_TEXT if c != "state")
    flags = ", ".join(f"{c}::varchar AS {c}" for c in SELECT_FLAGS)
    parts = [
        *KEPT_SQL,
        "state_shares AS (SELECT state AS value, sum(count(*)) OVER (ORDER BY state) / sum(count(*)) OVER () AS high "
        "FROM train_rows WHERE state IS NOT NULL GROUP BY 1)",
        f"m_filled AS (SELECT product_id, split, {LABEL_SQL}, {drawn} AS state, {texts}, {flags}, {', '.join(SELECT_NUMBERS)} FROM "
        "(SELECT *, ('0x' || substr(md5('25:state:' || product_id::varchar), 1, 13))::bigint / pow(16, 13) AS u "
        "FROM entity JOIN parted USING (product_id, condition)))",
        "m_train AS (SELECT * FROM m_filled WHERE split = 'train')",
    ]
    cells = []
    for c in SELECT_TEXT + SELECT_FLAGS:
        cells.append(f"{rare_sql(c, 2, 'm_train') if c in RARE else c} AS {c}")
    for c in SELECT_NUMBERS:
        cells.append(f"CASE WHEN c_{c} THEN ({binned_sql(c, 'm_train')})::varchar END AS {c}")
        cells.append(f"{c}::double AS raw_{c}")
    parts.append(f"m_grouped AS (SELECT product_id, split, label, {', '.join(cells)} FROM m_filled, kept)")
    parts.append("m_grouped_train AS (SELECT * FROM m_grouped WHERE split = 'train')")
    parts += [f"m_codes_{c} AS ({code_sql(c, 'm_grouped_train')})" for c in SELECT_TEXT + SELECT_FLAGS + SELECT_NUMBERS]
    return parts


E5_SQL = " UNION ALL ".join(
    [
        f"SELECT product_id, split, label, '{c}' AS variable, NULL::varchar AS text, "
        f"(SELECT code FROM m_codes_{c} WHERE value = {c}) AS number FROM m_grouped, kept WHERE k_{c}"
        for c in SELECT_TEXT + SELECT_FLAGS
    ]
    + [
        f"SELECT product_id, split, label, '{c}', NULL, round(CASE WHEN c_{c} THEN (SELECT code FROM m_codes_{c} WHERE value = {c}) "
        f"ELSE raw_{c} END, 4) FROM m_grouped, kept WHERE k_{c}"
        for c in SELECT_NUMBERS
    ]
)


@query("e5_engineered_matrix", with_products(E5_SQL, SPLIT_SQL, *_matrix_sql()))
def _engineered(spark, sf_dir):
    return long_form(W.prepare_matrix(products(spark, sf_dir), KEY, TARGET)[3])


@query("p1_own_stage", "SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer")
def _own_stage(spark, sf_dir):
    """A stage a user adds by subclassing."""

    class AddOne(Step):
        def _transform(self, df):
            return df.withColumns({c: F.col(c) + 1 for c in self.option("columns")})

    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return AddOne(columns=["c_acctbal"]).transform(rows)


# --- evaluation of given scores -----------------------------------------------

SCORED_SQL = (
    "scored AS (SELECT event_id, event_type, round(value / (value + 20), 2) AS score, "
    "((value > 12) <> (event_type = 'error'))::int AS label FROM events)"
)


def scores(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.round(value / (value + 20), 2).alias("score"),
        ((value > 12) != (F.col("event_type") == "error")).cast("int").alias("label"),
    )


@query(
    "m2_score_table",
    f"WITH {SCORED_SQL} SELECT event_id, round(1 - score, 4) AS p0, score AS p1, (score >= 0.5)::int AS prediction FROM scored",
)
def _score_table(spark, sf_dir):
    rows = T.with_scores(scores(spark, sf_dir), F.col("score"))
    return rounded(rows.select("event_id", "p0", "p1", "prediction"))


AUC_SQL = (
    "(sum(rank) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) "
    "/ (count(*) FILTER (label = 1) * count(*) FILTER (label = 0))"
)


@query(
    "m3_roc_auc",
    f"WITH {SCORED_SQL} SELECT round({AUC_SQL}, 4) AS auc FROM (SELECT label, rank() OVER (ORDER BY score) + "
    "(count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rank FROM scored)",
)
def _auc(spark, sf_dir):
    return rounded(M.roc_auc(scores(spark, sf_dir)))


@query(
    "w2_tied_ranks_by_group",
    f"WITH {SCORED_SQL} SELECT event_type, round({AUC_SQL}, 4) AS auc FROM (SELECT event_type, label, rank() OVER "
    "(PARTITION BY event_type ORDER BY score) + (count(*) OVER (PARTITION BY event_type, score) - 1) / 2.0 AS rank FROM scored) GROUP BY 1",
)
def _group_auc(spark, sf_dir):
    return rounded(M.roc_auc(scores(spark, sf_dir), by=["event_type"]))


@query(
    "m4_log_loss",
    f"WITH {SCORED_SQL} SELECT event_type, round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 4) AS log_loss FROM "
    "(SELECT *, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scored) GROUP BY 1",
)
def _log_loss(spark, sf_dir):
    return rounded(M.log_loss(scores(spark, sf_dir), by=["event_type"]))


@query(
    "m5_roc_points",
    f"""WITH {SCORED_SQL} SELECT threshold, round(fpr, 10) AS fpr, round(tpr, 10) AS tpr FROM (
      SELECT score AS threshold, sum(count(*) FILTER (label = 0)) OVER (ORDER BY score DESC) / (SELECT count(*) FROM scored WHERE label = 0) AS fpr,
      sum(count(*) FILTER (label = 1)) OVER (ORDER BY score DESC) / (SELECT count(*) FROM scored WHERE label = 1) AS tpr
      FROM scored GROUP BY score UNION ALL SELECT 'inf'::double, 0.0, 0.0)""",
)
def _roc(spark, sf_dir):
    return rounded(M.roc_points(scores(spark, sf_dir)), 10)


@query(
    "m6_confusion",
    f"""WITH {SCORED_SQL} SELECT event_type, count(*) FILTER (score > 0.5 AND label = 1) AS tp, count(*) FILTER (score > 0.5 AND label = 0) AS fp,
      count(*) FILTER (score <= 0.5 AND label = 1) AS fn, count(*) FILTER (score <= 0.5 AND label = 0) AS tn FROM scored GROUP BY 1""",
)
def _confusion(spark, sf_dir):
    return M.confusion(scores(spark, sf_dir), 0.5, by=["event_type"])


SWEEP_SQL = """cells AS (SELECT step, count(*) FILTER (score >= step * 0.01::double AND label = 1) AS tp,
    count(*) FILTER (score >= step * 0.01::double AND label = 0) AS fp, count(*) FILTER (score < step * 0.01::double AND label = 1) AS fn,
    count(*) FILTER (score < step * 0.01::double AND label = 0) AS tn FROM scored, (SELECT unnest(range(101))::int AS step) GROUP BY step),
  sweep AS (SELECT *, (coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2.0 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2 AS macro_f1 FROM cells)"""


@query(
    "m7_threshold_sweep",
    f"WITH {SCORED_SQL}, {SWEEP_SQL} SELECT step, round(step * 0.01::double, 4) AS threshold, tp, fp, fn, tn, round(macro_f1, 4) AS macro_f1 FROM sweep",
)
def _sweep(spark, sf_dir):
    return rounded(M.threshold_sweep(scores(spark, sf_dir)))


@query(
    "m7_best_threshold",
    f"WITH {SCORED_SQL}, {SWEEP_SQL} SELECT step, round(macro_f1, 4) AS macro_f1 FROM sweep ORDER BY sweep.macro_f1 DESC, step LIMIT 1",
)
def _best_threshold(spark, sf_dir):
    return rounded(M.best_threshold(scores(spark, sf_dir)).select("step", "macro_f1"))


@query(
    "m8_classification_report",
    f"""WITH {SCORED_SQL}, c AS (SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp,
      count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM scored),
    classes AS (SELECT '0' AS name, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fp + fn) AS f1, tn + fp AS support FROM c
      UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c)
    SELECT name, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM (
      SELECT * FROM classes
      UNION ALL SELECT 'accuracy', (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn), (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn FROM c
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint FROM classes
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support)::bigint FROM classes)""",
)
def _report(spark, sf_dir):
    return rounded(M.classification_report(scores(spark, sf_dir), 0.5))


# --- training -----------------------------------------------------------------


#: Prepared and trained once per session and data folder, read by the queries below.
_TRAINED: dict = {}


def matrix(spark, sf_dir):
    """The engineered matrix and its features, written once per session and data folder."""
    name = (spark.sparkContext.applicationId, sf_dir, "matrix")
    if name not in _TRAINED:
        _, _, features, rows = W.prepare_matrix(products(spark, sf_dir), KEY, TARGET)
        _TRAINED[name] = rows, features
    return _TRAINED[name]


def trained(spark, sf_dir):
    """The tuned model over train and validation rows, with its matrix."""
    name = (spark.sparkContext.applicationId, sf_dir, "both")
    if name not in _TRAINED:
        rows, features = matrix(spark, sf_dir)
        _TRAINED[name] = rows, features, T.train(rows, features)
    return _TRAINED[name]


def stopped(spark, sf_dir):
    """The model over training rows, cut at its best round on validation rows, and the curve."""
    name = (spark.sparkContext.applicationId, sf_dir, "stopped")
    if name not in _TRAINED:
        rows, features, _ = trained(spark, sf_dir)
        _TRAINED[name] = T.fit_with_early_stop(rows, features, BoostingParams())
    return _TRAINED[name]


def in_range(c):
    return (F.col(c) >= 0) & (F.col(c) <= 1)


PARTS_SQL = "SELECT split, count(*) AS n, count(*) AS n_in_range"


# Scores of trees have no SQL. The queries return facts that are computed from
# them, and the statements say what the facts must be.
@query(
    "m1_trained_scores",
    with_products(
        f"SELECT product_id, split, {LABEL_SQL}, true AS in_range, true AS sums_to_one, true AS decided "
        "FROM entity JOIN parted USING (product_id, condition)",
        SPLIT_SQL,
    ),
)
def _trained(spark, sf_dir):
    rows, _, model = trained(spark, sf_dir)
    return T.scored(model, rows).select(
        KEY,
        "split",
        "label",
        (in_range("p0") & in_range("p1")).alias("in_range"),
        (F.abs(F.col("p0") + F.col("p1") - 1) < 1e-12).alias("sums_to_one"),
        (F.col("prediction") == (F.col("p1") >= 0.5).cast("int")).alias("decided"),
    )


@query(
    "m3_trained_metrics",
    with_products(
        "SELECT split, 'used' AS positive_class, true AS auc_matches, true AS loss_matches, true AS better_than_chance "
        "FROM parted GROUP BY split",
        SPLIT_SQL,
    ),
)
def _trained_metrics(spark, sf_dir):
    """Metrics per split beside the same from the ranks and losses of the scores."""
    rows, _, model = trained(spark, sf_dir)
    scores_ = T.scored(model, rows)
    # Tied scores are one row, so no task ranks the rows of a split.
    one = F.lit(1).cast("bigint")
    counts = scores_.groupBy("split", "p1").agg(
        F.sum(one).alias("n"), F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranked = running_totals(counts, ["split"], ["p1"], {"cum": "n"}).groupBy("split").agg(
        F.sum(F.col("pos") * (F.col("cum") - (F.col("n") - 1) / 2)).alias("places"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    losses = scores_.groupBy("split").agg(
        F.avg(-F.ln(F.when(F.col("label") == 1, F.col("p1")).otherwise(F.col("p0")))).alias("loss_again")
    )
    pos, neg = F.col("pos"), F.col("neg")
    area = ((F.col("places") - pos * (pos + 1) / 2) / (pos * neg)).alias("auc_again")
    again = ranked.select("split", area).join(losses, "split")
    return W.split_metrics(scores_).join(again, "split").select(
        "split",
        "positive_class",
        (F.abs(F.col("auc") - F.col("auc_again")) < 1e-9).alias("auc_matches"),
        (F.abs(F.col("log_loss") - F.col("loss_again")) < 1e-9).alias("loss_matches"),
        ((F.col("split") == "test") | (F.col("auc") > 0.5)).alias("better_than_chance"),
    )


@query(
    "m9_importance",
    "SELECT 1.0::double AS total_gain, 0::bigint AS n_negative, 0::bigint AS n_unknown, true AS sorted FROM region LIMIT 1",
)
def _importance(spark, sf_dir):
    rows, features, model = trained(spark, sf_dir)
    gains = T.importance(model, spark)
    order = [r.gain for r in gains.collect()]
    return rounded(
        gains.agg(
            F.sum("gain").alias("total_gain"),
            F.count_if(F.col("gain") < 0).alias("n_negative"),
            F.count_if(~F.col("feature").isin(*rows.columns) | ~F.col("feature").isin(*features)).alias("n_unknown"),
            F.lit(order == sorted(order, reverse=True)).alias("sorted"),
        ),
        6,
    )


@query(
    "m11_early_stopping",
    with_products(
        f"{PARTS_SQL}, true AS kept_up_to_best, true AS patience_kept FROM parted GROUP BY split",
        SPLIT_SQL,
    ),
)
def _early_stopping(spark, sf_dir):
    """The cut model scores all rows; its rounds end at the best area, and no better one came within the patience."""
    rows = trained(spark, sf_dir)[0]
    model, curve = stopped(spark, sf_dir)
    kept = len(T.booster_of(model).trees)
    areas = [auc for _, auc in curve]
    ahead = areas[kept : kept + 25]
    return (
        T.scored(model, rows)
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.count_if(in_range("p1")).alias("n_in_range"))
        .withColumn("kept_up_to_best", F.lit(areas[kept - 1] == max(areas[:kept])))
        .withColumn("patience_kept", F.lit(all(auc <= areas[kept - 1] for auc in ahead)))
    )


@query(
    "m14_learning_curve",
    with_products(
        "SELECT split, 93::bigint AS n_rounds, true AS areas_in_range, true AS last_loss_matches, true AS last_area_close "
        "FROM parted WHERE split <> 'test' GROUP BY split",
        SPLIT_SQL,
    ),
)
def _learning_curve(spark, sf_dir):
    """The curve's last round against the metrics of the whole model."""
    rows, _, model = trained(spark, sf_dir)
    some = rows.where("split IN ('train', 'val')")
    curve = T.learning_curve(model, some, ["split"])
    last = F.max_by(F.struct("auc", "log_loss"), "round")
    ends = curve.groupBy("split").agg(
        F.count("*").alias("n_rounds"), F.bool_and(in_range("auc")).alias("areas_in_range"), last.alias("last")
    )
    whole = W.split_metrics(T.scored(model, some)).select("split", "auc", "log_loss")
    return ends.join(whole, "split").select(
        "split",
        "n_rounds",
        "areas_in_range",
        (F.abs(F.col("last.log_loss") - F.col("log_loss")) < 1e-9).alias("last_loss_matches"),
        (F.abs(F.col("last.auc") - F.col("auc")) < 1e-3).alias("last_area_close"),
    )


@query(
    "m15_refit_at_best_round",
    with_products(f"{PARTS_SQL}, true AS rounds_match, true AS one_best FROM parted GROUP BY split", SPLIT_SQL),
)
def _refit(spark, sf_dir):
    """A new model over train and validation rows with as many rounds as were best."""
    rows, features, _ = trained(spark, sf_dir)
    _, curve = stopped(spark, sf_dir)
    best = T.best_round(curve, patience=25)
    final = T.train(rows, features, replace(BoostingParams(), rounds=best + 1))
    return (
        T.scored(final, rows)
        .groupBy("split")
        .agg(F.count("*").alias("n"), F.count_if(in_range("p1")).alias("n_in_range"))
        .withColumn("rounds_match", F.lit(len(T.booster_of(final).trees) == best + 1))
        .withColumn("one_best", F.lit(sum(r == best for r, _ in curve) == 1))
    )


@query(
    "m16_run_log",
    f"""WITH {SCORED_SQL} SELECT 'given scores' AS name, '{{"source": "events"}}' AS params, 'auc' AS metric, round({AUC_SQL}, 4) AS value
      FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rank FROM scored)
    UNION ALL SELECT 'given scores', '{{"source": "events"}}', 'log_loss', round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 4) FROM
      (SELECT *, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scored)""",
)
def _run_log(spark, sf_dir):
    auc = M.roc_auc(scores(spark, sf_dir)).first().auc
    loss = M.log_loss(scores(spark, sf_dir)).first().log_loss
    path = new_path(spark, "runs")
    T.log_run(spark, path, "given scores", {"source": "events"}, {"auc": auc, "log_loss": loss})
    return rounded(spark.read.parquet(path).select("name", "params", "metric", "value"))


@query(
    "s5_saved_lists",
    with_products("SELECT product_id, " + ", ".join(f"{binned_sql(c, 'entity')} AS {c}" for c in BINNED) + " FROM entity"),
)
def _saved_lists(spark, sf_dir):
    """Fitted values travel with the saved stage, not in a settings file."""
    rows = products(spark, sf_dir, []).select(KEY, *BINNED)
    path = new_path(spark, "fitted")
    E.GeometricBins(columns=BINNED, bins=8).fit(rows).save(path)
    return E.CutBins.load(path).transform(rows)


@query("s7_saved_model", with_products("SELECT split, count(*) AS n, count(*) AS n_equal FROM parted GROUP BY split", SPLIT_SQL))
def _saved_model(spark, sf_dir):
    """Scores of the saved and loaded model against those of the one in memory, row by row."""
    rows, _, model = trained(spark, sf_dir)
    path = new_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = T.scored(PipelineModel.load(path), rows).select(KEY, "split", F.col("p1").alias("again"))
    both = T.scored(model, rows).select(KEY, "p1").join(loaded, KEY)
    return both.groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("p1") == F.col("again")).alias("n_equal"))


@query(
    "f14_flags_as_features",
    with_products("SELECT product_id, local_pickup::varchar AS local_pickup, free_shipping::varchar AS free_shipping FROM entity"),
)
def _flag_features(spark, sf_dir):
    rows = products(spark, sf_dir, ["local_pickup", "free_shipping"]).select(KEY, "local_pickup", "free_shipping")
    return FlagsToText().transform(rows)
