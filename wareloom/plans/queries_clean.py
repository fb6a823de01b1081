"""Reading, flattening, cleaning and schema decisions."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wareloom.functions import columns as X
from wareloom.operators import clean as K
from wareloom.operators import decide as D
from wareloom.operators import flatten as N
from wareloom.operators.counts import schema_rows, shape
from wareloom.operators.entity import entity_aggregate
from wareloom.operators.select import MatchColumns
from wareloom.plans.driver_tables import (
    DOCUMENT_SQL,
    FLAT_SQL,
    listing_documents,
    listing_rows,
    table,
)
from wareloom.plans.preprocessing import apply_fitted, preprocess
from wareloom.plans.registry import query, rounded
from wareloom.plans.sql_texts import entity_part, stored_columns, with_listing
from wareloom.schema import BUSINESS_NAMES, NULL_TOKENS
from wareloom.sources import listings as S
from wareloom.sources.store import new_path


def with_docs(body: str, *parts: str) -> str:
    return "WITH " + ",\n".join([DOCUMENT_SQL, *parts]) + "\n" + body


def frame_of(spark, rows, schema):
    """Decisions taken from the tables, as rows."""
    return spark.createDataFrame(rows, schema)


# --- sources and sinks --------------------------------------------------------

DOC_FACTS = "id, title, condition, seller_id, len(attributes) AS n_attributes, len(variations) AS n_variations, country, city"


def document_facts(docs):
    def size(c):
        return F.when(F.size(c) > 0, F.size(c)).cast("bigint")

    return docs.select(
        "id",
        "title",
        "condition",
        "seller_id",
        size("attributes").alias("n_attributes"),
        size("variations").alias("n_variations"),
        F.col("seller_address.country.name").alias("country"),
        F.col("seller_address.city.name").alias("city"),
    )


@query(
    "s1_json_lines",
    with_docs(
        f"SELECT {DOC_FACTS}, CASE WHEN id[2:]::bigint % 2 = 0 THEN start_time ELSE date_trunc('second', start_time) END AS start_time, "
        "stop_time FROM docs"
    ),
)
def _json_lines(spark, sf_dir):
    """Clock times as milliseconds in every other document, as text in the rest."""
    docs = listing_documents(spark, sf_dir)
    even = F.substring("id", 2, 20).cast("bigint") % 2 == 0
    start, stop = F.col("start_time").cast("bigint"), F.try_to_timestamp("stop_time", F.lit(X.CLOCK_FORMAT))
    numbers = docs.where(even).withColumns({"start_time": start, "stop_time": F.unix_millis(stop)})
    texts = docs.where(~even).withColumn("start_time", F.date_format(F.timestamp_millis(start), X.CLOCK_FORMAT))
    lines = [part.select(F.to_json(F.struct("*")).alias("line")) for part in (numbers, texts)]
    read = S.read_listings(spark, S.write_lines(lines[0].union(lines[1]), new_path(spark, "listings")))
    times = K.ParseTimes(patterns=["start_time", "stop_time"]).transform(read.select("id", "start_time", "stop_time"))
    return document_facts(read).join(times, "id")


@query("s2_frame_from_text", with_docs(f"SELECT {DOC_FACTS} FROM docs"))
def _from_text(spark, sf_dir):
    lines = listing_documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("line"))
    return document_facts(S.as_frame(spark, S.parse_listings(lines, "line")))


@query(
    "s4_stored_entities",
    with_listing(f"SELECT {stored_columns('product_id')} FROM entity", entity_part("product_id")),
)
def _stored(spark, sf_dir):
    entities = entity_aggregate(listing_rows(spark, sf_dir), "product_id", ordered=False)
    path = S.write_table(entities, new_path(spark, "entities"))
    return rounded(S.read_table(spark, path))


# --- nested data --------------------------------------------------------------


@query("n1_product_id", with_docs("SELECT id AS product_id FROM docs"))
def _product_id(spark, sf_dir):
    return N.flatten_listings(listing_documents(spark, sf_dir).select("id"))


@query("n2_joined_lists", with_docs("SELECT id, sub_status, deal_ids, tags, descriptions FROM docs"))
def _joined_lists(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select("id", "sub_status", "deal_ids", "tags", "descriptions")
    return N.join_text_lists(docs)


@query(
    "n3_prefixed_fields",
    with_docs(
        "SELECT id, attribute.id AS attr_id, attribute.name AS attr_name, attribute.group_id AS attr_attribute_group_id, "
        "attribute.group_name AS attr_attribute_group_name, attribute.value AS attr_value_name FROM flat_a",
        "flat_a AS (SELECT id, unnest(CASE WHEN len(attributes) > 0 THEN attributes ELSE [NULL] END) AS attribute FROM docs)",
    ),
)
def _prefixed(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select("id", "attributes")
    return N.explode_structs(docs, "attributes", "attr_").drop("attr_value_id")


@query(
    "n4_explode_keeps_empty",
    with_docs(
        "SELECT id, payment AS payment FROM flat_p",
        "flat_p AS (SELECT id, unnest(CASE WHEN len(payments) > 0 THEN payments ELSE [NULL] END) AS payment FROM docs)",
    ),
)
def _exploded(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select(
        "id", F.col("non_mercado_pago_payment_methods").alias("payment")
    )
    return N.explode_list(docs, "payment").withColumn("payment", F.col("payment.id"))


@query(
    "n5_unnest_struct",
    with_docs("SELECT id, local_pick_up, free_shipping, shipping_mode AS mode FROM docs"),
)
def _unnested(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select("id", "shipping")
    return N.spread_struct(docs, "shipping").drop("free_methods")


@query(
    "n6_prefixed_struct",
    with_docs(
        "SELECT id, local_pick_up AS shipping_local_pick_up, free_shipping AS shipping_free_shipping, shipping_mode FROM docs"
    ),
)
def _prefixed_struct(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select("id", "shipping")
    return N.spread_struct(docs, "shipping", "shipping_").drop("shipping_free_methods")


@query(
    "n7_place_names",
    with_docs(
        "SELECT id, country AS seller_address_country, state AS seller_address_state, city AS seller_address_city FROM docs"
    ),
)
def _place_names(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select("id", "seller_address")
    return N.keep_names(N.spread_struct(docs, "seller_address", "seller_address_"))


@query(
    "n8_free_methods",
    with_docs(
        "SELECT id AS product_id, shipping_mode, m.id AS id, NULL::varchar AS rule_value, m.free_mode AS rule_free_mode "
        "FROM (SELECT *, unnest(CASE WHEN len(free_methods) > 0 THEN free_methods ELSE [NULL] END) AS m FROM docs)"
    ),
)
def _free_methods(spark, sf_dir):
    flat = N.flatten_listings(listing_documents(spark, sf_dir).select("id", "shipping"))
    return flat.select("product_id", "shipping_mode", "id", "rule_value", "rule_free_mode")


@query(
    "n9_combinations",
    with_docs(
        "SELECT id AS product_id, v.id AS var_id, unnest(CASE WHEN len(v.combinations) > 0 THEN v.combinations ELSE [NULL] END) AS var_comb_id "
        "FROM (SELECT id, unnest(CASE WHEN len(variations) > 0 THEN variations ELSE [NULL] END) AS v FROM docs)"
    ),
)
def _combinations(spark, sf_dir):
    flat = N.flatten_listings(listing_documents(spark, sf_dir).select("id", "variations"))
    return flat.select("product_id", "var_id", "var_comb_id")


FLAT_COLUMNS = ["product_id", "nmp_pm_id", "var_id", "attr_id", "pic_id", "id", "rule_free_mode", "var_comb_id"]


@query(
    "n10_flat_rows",
    with_docs(
        "SELECT id AS product_id, payment AS nmp_pm_id, variation.id AS var_id, attribute.id AS attr_id, "
        "'P' || id[2:] || picture AS pic_id, free_method.id AS id, free_method.free_mode AS rule_free_mode, "
        "combination AS var_comb_id FROM flat",
        FLAT_SQL,
    ),
)
def _flat(spark, sf_dir):
    return N.flatten_listings(listing_documents(spark, sf_dir)).select(*FLAT_COLUMNS)


CLEAN_SQL = """clean AS (
  SELECT lower(country) AS country, lower(state) AS state, lower(nullif(city, 'N/A')) AS city,
    lower(trim(condition)) AS target, base_price AS price, local_pick_up AS local_pickup, free_shipping,
    shipping_mode, seller_id, lower(site_id) AS site_id, lower(listing_type_id) AS listing_type,
    lower(attribute.group_id) AS attribute_group_id, lower(attribute.group_name) AS attribute_group,
    lower(attribute.id) AS attribute_id, buying_mode, last_updated, lower(id) AS product_id, accepts_mercadopago,
    lower(currency_id) AS currency, lower(trim(replace(title, chr(9), ' '))) AS title, automatic_relist, date_created,
    stop_time, lower(status) AS status, initial_quantity, start_time, sold_quantity, available_quantity
  FROM flat)"""

for _level, _key in {"product": "product_id", "seller": "seller_id", "site": "site_id"}.items():

    @query(
        f"p2_preprocess_{_level}",
        with_docs(
            f"SELECT {stored_columns(_key)} FROM entity", FLAT_SQL, CLEAN_SQL, entity_part(_key, source="clean")
        ),
    )
    def _preprocessed(spark, sf_dir, key=_key):
        _, entities = preprocess(listing_documents(spark, sf_dir), key)
        return rounded(entities)


@query(
    "p2_preprocess_rows",
    with_docs(
        "SELECT DISTINCT product_id, target, title, city, attribute_id, start_time, stop_time, price FROM clean",
        FLAT_SQL,
        CLEAN_SQL,
    ),
)
def _flat_clean(spark, sf_dir):
    """The exploratory variant: cleaned rows without aggregation."""
    _, rows = preprocess(listing_documents(spark, sf_dir), key=None)
    named = K.RenameColumns(mapping=BUSINESS_NAMES).transform(rows)
    return named.select(
        "product_id", "target", "title", "city", "attribute_id", "start_time", "stop_time", "price"
    ).distinct()


@query(
    "s6_saved_stages",
    with_docs(
        f"SELECT {stored_columns('product_id')} FROM entity",
        FLAT_SQL,
        CLEAN_SQL,
        entity_part("product_id", source="clean"),
    ),
)
def _saved_stages(spark, sf_dir):
    docs = listing_documents(spark, sf_dir)
    fitted, _ = preprocess(docs)
    path = new_path(spark, "stages")
    fitted.write().overwrite().save(path)
    return rounded(apply_fitted(PipelineModel.load(path), docs))


# --- names and columns --------------------------------------------------------


@query("c1_normalized_names", "SELECT c_custkey AS customer_key, c_name AS full_name, c_mktsegment AS segment FROM customer")
def _names(spark, sf_dir):
    odd = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" Customer Key"), F.col("c_name").alias("FULL name "), F.col("c_mktsegment").alias("Segment")
    )
    return K.NormalizeNames().transform(odd)


@query(
    "c2_business_names",
    "SELECT c_custkey AS seller_id, c_mktsegment AS listing_type, c_acctbal AS price FROM customer",
)
def _renamed(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    mapping = {"c_custkey": "seller_id", "c_mktsegment": "listing_type", "c_acctbal": "price"}
    return K.RenameColumns(mapping=mapping).transform(customer)


@query("c3_dropped_columns", "SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def _dropped(spark, sf_dir):
    step = K.DropColumns(columns=["c_acctbal", "c_nationkey"], strict=True)
    return step.transform(table(spark, sf_dir, "customer"))


# Column -> expression, by type: what duplicate columns are looked for among.
COPIES = {
    "number": {
        "l_quantity": "l_quantity",
        "quantity_copy": "l_quantity",
        "quantity_partly": "CASE WHEN l_tax > 0.045 THEN l_quantity END",
        "quantity_elsewhere": "CASE WHEN l_tax <= 0.045 THEN l_quantity + 1 END",
        "l_extendedprice": "l_extendedprice",
        "empty_number": "CAST(NULL AS double)",
        "other_empty_number": "CAST(NULL AS double)",
    },
    "text": {
        "empty_text": "CAST(NULL AS {text})",
        "l_returnflag": "l_returnflag",
        "flag_copy": "l_returnflag",
        "l_linestatus": "l_linestatus",
    },
}
# An empty text stands before the empty numbers, which it must not take with it.
COPY_ORDER = ["empty_text", *COPIES["number"], *[c for c in COPIES["text"] if c != "empty_text"]]
COPY_COLUMNS = {c: text for columns in COPIES.values() for c, text in columns.items()}


def copies(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.selectExpr(*[f"{COPY_COLUMNS[c].format(text='string')} AS {c}" for c in COPY_ORDER])


# Same type, nulls ignored, nothing in common counts as equal; a column without values equals others without.
@query(
    "c4_duplicate_columns",
    "WITH t AS (SELECT "
    + ", ".join(f"{COPY_COLUMNS[c].format(text='varchar')} AS {c}" for c in COPY_ORDER)
    + " FROM lineitem) SELECT DISTINCT column_name FROM ("
    + " UNION ALL ".join(
        f"SELECT '{b}' AS column_name FROM t HAVING CASE WHEN count({a}) = 0 OR count({b}) = 0 "
        f"THEN count({a}) = 0 AND count({b}) = 0 ELSE coalesce(bool_and({a} = {b}), true) END"
        for columns in COPIES.values()
        for a, b in combinations(sorted(columns, key=COPY_ORDER.index), 2)
    )
    + ")",
)
def _duplicates(spark, sf_dir):
    found = D.duplicate_columns(copies(spark, sf_dir))
    return frame_of(spark, [(c,) for c in found], "column_name string")


SPARSE = ["state", "city", "attribute_group_id", "attribute_id", "stop_time", "price", "title"]


@query(
    "c5_sparse_columns",
    with_listing(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name FROM listing HAVING avg(({c} IS NULL)::int) > 0.05" for c in SPARSE
        )
    ),
)
def _sparse(spark, sf_dir):
    fitted = D.DropSparseColumns(threshold=0.05).fit(listing_rows(spark, sf_dir).select(*SPARSE))
    return frame_of(spark, [(c,) for c in fitted.option("columns")], "column_name string")


@query(
    "c6_unneeded_columns",
    with_docs("SELECT id, title, tags FROM docs"),
)
def _unneeded(spark, sf_dir):
    docs = listing_documents(spark, sf_dir).select(
        "id", "title", "tags", "pictures", "thumbnail", "permalink", "descriptions", F.col("id").alias("pic_id")
    )
    kept = K.DropUnneeded().transform(docs.withColumn("tags", F.array_join("tags", ",")))
    return kept


@query(
    "c7_columns_by_name_and_type",
    with_listing("SELECT attribute_group_id, attribute_name, attribute_group, attribute_id FROM listing"),
)
def _chosen(spark, sf_dir):
    rows = listing_rows(spark, sf_dir)
    return rows.select(*K.columns_like(rows, "attribute", (K.T.StringType,)))


KIND_SQL = " UNION ALL ".join(
    [
        f"SELECT '{c}' AS variable, CASE WHEN count(DISTINCT {c}) + max(({c} IS NULL)::int) <= 5 "
        f"THEN 'discrete' ELSE 'continuous' END AS kind FROM events_and_kinds"
        for c in ["user_id", "value", "flag"]
    ]
    + [
        "SELECT 'event_type', 'categorical' FROM events_and_kinds HAVING count(*) > 0",
        "SELECT 'late', 'categorical' FROM events_and_kinds HAVING count(*) > 0",
        "SELECT 'ts', 'temporal' FROM events_and_kinds HAVING count(*) > 0",
    ]
)


@query(
    "c8_variable_kinds",
    "WITH events_and_kinds AS (SELECT user_id, value, event_type, ts, CASE WHEN value > 10 THEN 1 WHEN value > 5 THEN 0 END "
    "AS flag, value > 100 AS late FROM events) " + KIND_SQL,
)
def _kinds(spark, sf_dir):
    value = F.col("value")
    events = table(spark, sf_dir, "events").select(
        "user_id",
        "value",
        "event_type",
        "ts",
        F.when(value > 10, 1).when(value > 5, 0).alias("flag"),
        (value > 100).alias("late"),
    )
    kinds = D.variable_kinds(events)
    rows = [(c, kind) for kind, columns in kinds.items() for c in columns]
    return frame_of(spark, rows, "variable string, kind string")


@query("c9_flags_as_text", with_listing("SELECT product_id, local_pickup::varchar AS local_pickup FROM listing"))
def _flags(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).select("product_id", "local_pickup")
    return K.FlagsToText(columns=["local_pickup"]).transform(rows)


@query(
    "c10_id_kept_as_column",
    with_listing("SELECT product_id, round(total_amount, 4) AS total_amount FROM entity", entity_part("product_id")),
)
def _id_column(spark, sf_dir):
    """The id stays an ordinary column next to the features; there is no row index."""
    rows = entity_aggregate(listing_rows(spark, sf_dir), "product_id", modes=[], ordered=False)
    return rounded(rows.select("product_id", "total_amount"))


@query(
    "c11_aligned_columns",
    "SELECT o_orderkey, o_orderstatus, NULL::double AS o_totalprice FROM orders",
)
def _aligned(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fitted = MatchColumns(keep=["o_orderkey"]).fit(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"))
    return fitted.transform(orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"))


@query("c13_shape", with_listing("SELECT count(*) AS n_rows, 30::bigint AS n_columns FROM listing"))
def _shape(spark, sf_dir):
    return shape(listing_rows(spark, sf_dir))


@query(
    "c13_schema",
    "SELECT t.position, t.name, t.type, (SELECT count(*) FROM region) AS n_rows FROM (VALUES (0, 'r_regionkey', 'int'), "
    "(1, 'r_name', 'string')) t(position, name, type)",
)
def _schema(spark, sf_dir):
    return schema_rows(table(spark, sf_dir, "region"))


# --- cleaning -----------------------------------------------------------------

SEGMENT_NOTE = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'N/A' WHEN 'BUILDING' THEN '' WHEN 'FURNITURE' THEN ' NULL' "
    "WHEN 'HOUSEHOLD' THEN 'none' ELSE c_mktsegment END"
)
TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


@query(
    "k1_null_tokens",
    f"SELECT c_custkey, CASE WHEN note NOT IN ({TOKENS}) THEN note END AS note "
    f"FROM (SELECT c_custkey, {SEGMENT_NOTE} AS note FROM customer)",
)
def _null_tokens(spark, sf_dir):
    notes = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{SEGMENT_NOTE} AS note")
    return K.NullTokens().transform(notes)


@query("k2_trimmed_lower", "SELECT c_custkey, lower(c_name) AS name FROM customer")
def _trimmed(spark, sf_dir):
    padded = F.concat(F.lit("\t "), "c_name", F.lit(" \n")).alias("name")
    return K.TrimLower().transform(table(spark, sf_dir, "customer").select("c_custkey", padded))


@query(
    "k3_parsed_times",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 20000 THEN o_orderdate + to_microseconds(o_custkey) END AS date_created,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + to_milliseconds(o_custkey) ELSE o_orderdate END AS start_time,
       o_orderdate + to_milliseconds(CASE WHEN o_orderkey % 2 = 1 THEN 1 ELSE 0 END) AS stop_time,
       o_orderdate + to_milliseconds(o_custkey) AS made_time, o_totalprice AS due_time FROM orders""",
)
def _parsed(spark, sf_dir):
    """Six-digit fractions, and both clock columns in both layouts: text and milliseconds."""
    millis, clock = "unix_millis(cast(o_orderdate AS timestamp))", "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_totalprice > 20000 THEN concat(' \"', date_format(timestampadd(MICROSECOND, o_custkey, o_orderdate), "
        "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\"), '\"') ELSE 'soon' END AS date_created",
        f"CASE WHEN o_orderkey % 2 = 0 THEN cast({millis} + o_custkey AS string) ELSE {clock} END AS start_time",
        f"CASE WHEN o_orderkey % 2 = 1 THEN cast({millis} + 1 AS string) ELSE {clock} END AS stop_time",
        f"{millis} + o_custkey AS made_time",
        "o_totalprice AS due_time",
    )
    return K.ParseTimes().transform(orders)


@query(
    "k4_digit_text_to_number",
    """SELECT c_custkey, floor(abs(c_acctbal)) AS amount, c_custkey::varchar AS custom_id,
       CASE WHEN c_nationkey = 3 THEN 'x1' ELSE '12' END AS mixed FROM customer""",
)
def _digits(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "cast(cast(floor(abs(c_acctbal)) AS bigint) AS string) AS amount",
        "cast(c_custkey AS string) AS custom_id",
        "CASE WHEN c_nationkey = 3 THEN 'x1' ELSE '12' END AS mixed",
    )
    return D.DetectNumbers().fit(rows).transform(rows)


# --- scalar functions ---------------------------------------------------------


@query(
    "f1_string_cleaning",
    "SELECT event_id, replace(props, '\"', '') AS plain, lower(trim('  ' || event_type || ' ')) AS kind FROM events",
)
def _strings(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.replace("props", F.lit('"'), F.lit("")).alias("plain"),
        X.strip_lower(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("kind"),
    )


@query(
    "f2_digit_test",
    "SELECT event_id, regexp_full_match(value::varchar, '[0-9]+\\.?[0-9]*|\\.[0-9]+') AS digits, "
    "regexp_full_match(props, '[0-9]+\\.?[0-9]*|\\.[0-9]+') AS props_digits FROM events",
)
def _digit_test(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        X.is_digit_text(F.col("value").cast("string")).alias("digits"),
        X.is_digit_text(F.col("props")).alias("props_digits"),
    )


@query(
    "f3_membership",
    "SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS pressing FROM orders",
)
def _membership(spark, sf_dir):
    pressing = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return table(spark, sf_dir, "orders").select("o_orderkey", pressing.alias("pressing"))


@query(
    "f4_conditional",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band FROM orders",
)
def _conditional(spark, sf_dir):
    price = F.col("o_totalprice")
    band = F.when(price > 300000, "high").when(price > 100000, "mid").otherwise("low")
    return table(spark, sf_dir, "orders").select("o_orderkey", band.alias("band"))


@query(
    "f5_parse_date_text",
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS moment, date_trunc('microsecond', ts) AS stamp, "
    "date_trunc('millisecond', ts) AS short_stamp, date_trunc('millisecond', ts) AS number FROM events",
)
def _parse(spark, sf_dir):
    """Both layouts, fractions of six and three digits, and milliseconds as text."""
    text = F.when(F.col("event_type") != "error", F.date_format("ts", X.CLOCK_FORMAT)).otherwise(F.lit("??"))
    texts = {
        "moment": (text, True),
        "stamp": (F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), False),
        "short_stamp": (F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), False),
        "number": (F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), True),
    }
    return table(spark, sf_dir, "events").select(
        "event_id", *[X.parse_text_time(t, clock).cast("timestamp_ntz").alias(c) for c, (t, clock) in texts.items()]
    )


@query("f6_epoch_millis", "SELECT event_id, date_trunc('millisecond', ts) AS moment FROM events")
def _millis(spark, sf_dir):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", X.millis_time(millis).cast("timestamp_ntz").alias("moment")
    )


@query(
    "f7_hours_between",
    "SELECT l_orderkey, l_linenumber, round(date_sub('second', o_orderdate, l_shipdate + to_seconds(floor(l_extendedprice)::bigint)) "
    "/ 3600.0, 4) AS hours FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def _hours(spark, sf_dir):
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    end = F.timestamp_add("SECOND", F.floor("l_extendedprice"), F.col("l_shipdate"))
    hours = X.hours_between(F.col("o_orderdate"), end)
    return rounded(joined.select("l_orderkey", "l_linenumber", hours.alias("hours")))


@query(
    "f8_weekday_and_hour",
    """SELECT event_id, dayname(ts) AS weekday, hour(ts)::int AS hour, CASE dayname(ts) WHEN 'Monday' THEN 'Lunes'
       WHEN 'Tuesday' THEN 'Martes' WHEN 'Wednesday' THEN 'Miércoles' WHEN 'Thursday' THEN 'Jueves' WHEN 'Friday' THEN 'Viernes'
       WHEN 'Saturday' THEN 'Sábado' WHEN 'Sunday' THEN 'Domingo' END AS label FROM events""",
)
def _weekday(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", X.weekday_name(ts).alias("weekday"), F.hour(ts).alias("hour"), X.weekday_label(ts).alias("label")
    )


@query(
    "f9_logarithm",
    "SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount > 0 THEN ln(l_discount) END, 4) AS log_discount FROM lineitem",
)
def _logarithm(spark, sf_dir):
    return rounded(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", X.log_amount(F.col("l_discount")).alias("log_discount")
        )
    )


@query(
    "f10_product",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity, 4) AS amount FROM lineitem",
)
def _product(spark, sf_dir):
    amount = X.amount(F.col("l_extendedprice"), F.col("l_quantity"))
    return rounded(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", amount.alias("amount")))


@query(
    "f11_lists",
    with_docs(
        "SELECT id, name, names FROM (SELECT id, array_to_string(list_transform(attributes, lambda a: a.name), ',') AS names, "
        "unnest(CASE WHEN len(attributes) > 0 THEN list_transform(attributes, lambda a: a.name) ELSE [NULL] END) AS name FROM docs)"
    ),
)
def _lists(spark, sf_dir):
    names = F.transform("attributes", lambda a: a["name"])
    docs = listing_documents(spark, sf_dir).select(
        "id", F.nullif(F.array_join(names, ","), F.lit("")).alias("names"), names.alias("name")
    )
    return N.explode_list(docs, "name")


@query("f12_structs", "SELECT event_id, event_type AS event_kind, value AS event_value FROM events")
def _structs(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("event_type").alias("kind"), "value").alias("event")
    )
    return N.spread_struct(events, "event", "event_")


@query("f13_json", "SELECT event_id, (props::json ->> '$.k')::bigint AS k FROM events")
def _json(spark, sf_dir):
    parsed = F.from_json("props", "k bigint", {"mode": "FAILFAST"})
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "f14_casts",
    "SELECT c_custkey, TRY_CAST(CASE WHEN c_nationkey = 3 THEN 'x' ELSE c_custkey::varchar END AS double) AS number, "
    "(c_acctbal > 0)::varchar AS flag, (c_acctbal > 0)::int AS hit FROM customer",
)
def _casts(spark, sf_dir):
    text = F.when(F.col("c_nationkey") == 3, "x").otherwise(F.col("c_custkey").cast("string"))
    positive = F.col("c_acctbal") > 0
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.try_cast("double").alias("number"),
        positive.cast("string").alias("flag"),
        positive.cast("int").alias("hit"),
    )


@query(
    "f15_powers_and_roots",
    "SELECT p_partkey, round(pow(p_size, 0.125), 4) AS eighth, round(sqrt(p_retailprice), 4) AS root, "
    "least(p_size, 20) AS small, greatest(p_size, 20) AS large FROM part",
)
def _powers(spark, sf_dir):
    return rounded(
        table(spark, sf_dir, "part").select(
            "p_partkey",
            F.pow("p_size", F.lit(0.125)).alias("eighth"),
            F.sqrt("p_retailprice").alias("root"),
            F.least("p_size", F.lit(20)).alias("small"),
            F.greatest("p_size", F.lit(20)).alias("large"),
        )
    )


@query(
    "x14_variable_info",
    with_listing(
        " UNION ALL ".join(
            [
                f"SELECT 'categoricals_more_than_threshold' AS list, '{c}' AS variable FROM listing HAVING avg(({c} IS NULL)::int) > 0.05"
                for c in ["state", "attribute_group", "listing_type", "shipping_mode"]
            ]
            + [
                f"SELECT 'categoricals_less_than_threshold', '{c}' FROM listing "
                f"HAVING avg(({c} IS NULL)::int) > 0 AND avg(({c} IS NULL)::int) <= 0.05"
                for c in ["state", "attribute_group", "listing_type", "shipping_mode"]
            ]
            + [
                f"SELECT CASE WHEN count(DISTINCT {c}) > 5 THEN 'categoricals_high_cardinality' "
                f"ELSE 'categoricals_low_cardinality' END, '{c}' FROM listing"
                for c in ["state", "attribute_group", "listing_type", "shipping_mode"]
            ]
            + [
                "SELECT 'continuous_more_than_threshold', 'price' FROM listing HAVING avg((price IS NULL)::int) > 0.05",
                "SELECT 'continuous_less_than_threshold', 'price' FROM listing "
                "HAVING avg((price IS NULL)::int) > 0 AND avg((price IS NULL)::int) <= 0.05",
            ]
        )
    ),
)
def _variable_info(spark, sf_dir):
    rows = listing_rows(spark, sf_dir)
    info = D.variable_info(
        rows, continuous=["price"], categoricals=["state", "attribute_group", "listing_type", "shipping_mode"]
    )
    pairs = [(name, c) for name, columns in info.items() for c in columns]
    return frame_of(spark, pairs, "list string, variable string")


