"""Listings derived from the order tables.

The tables at hand hold orders, not listings. ``listing_rows`` presents them as
cleaned listing rows (one per line item), ``listing_documents`` as nested
documents (one per order). The SQL texts state the same mapping for checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.schema import LISTING_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region: 25 rows at every scale, hence the broadcast."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned listing rows; nulls and classes follow from the row's own values.

    Only the fixed-size place table is broadcast by hint. The other sides grow
    with the data and are left to the size-checked choice of the planner and
    to the splitting of hot join partitions at run time. Parts are joined last, so
    that the rows of a product lie together when products are aggregated; texts of
    places and customers are attached to orders or at the end, not carried along.
    """
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    joined = (
        line.join(orders.join(customer, orders.o_custkey == customer.c_custkey), line.l_orderkey == orders.o_orderkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(part, line.l_partkey == part.p_partkey)
        .join(F.broadcast(places(spark, sf_dir)), supplier.s_nationkey == F.col("n_nationkey"))
    )
    c = F.col
    returned = c("l_returnflag") == "R"
    no_attribute = c("l_tax") < 0.005
    no_state = (c("l_discount") < 0.005) & (c("l_tax") < 0.015)

    def unless(missing: Column, value: Column) -> Column:
        return F.when(~missing, value)

    return joined.select(
        F.lower("r_name").alias("country"),
        unless(no_state, F.lower("n_name")).alias("state"),
        F.lower(F.concat("n_name", F.lit("-"), "c_mktsegment")).alias("city"),
        F.when(returned == (c("p_size") < 28), "used").otherwise("new").alias("target"),
        c("p_retailprice").alias("price"),
        (c("l_quantity") > 25).alias("local_pickup"),
        (c("l_discount") > 0.055).alias("free_shipping"),
        F.when(c("l_quantity") < 2, "custom").otherwise(F.lower("l_linestatus")).alias("shipping_mode"),
        c("l_suppkey").alias("seller_id"),
        F.lower("r_name").alias("site_id"),
        F.lower("o_orderpriority").alias("listing_type"),
        unless(no_attribute, F.lower("p_brand")).alias("attribute_group_id"),
        unless(no_attribute, F.lower(F.concat("p_type", F.lit(" "), "p_brand"))).alias("attribute_name"),
        unless(no_attribute, F.lower("p_type")).alias("attribute_group"),
        unless(no_attribute, F.lower(F.concat("p_brand", F.lit("-"), "p_size"))).alias("attribute_id"),
        F.lower("p_type").alias("buying_mode"),
        F.lower(F.concat("p_brand", F.lit("/"), "p_type")).alias("category_id"),
        F.timestamp_add("SECOND", F.floor("l_extendedprice"), c("l_shipdate")).alias("last_updated"),
        c("l_partkey").alias("product_id"),
        (c("l_tax") < 0.075).alias("accepts_mercadopago"),
        F.when(c("l_discount") > 0.095, "usd").otherwise("ars").alias("currency"),
        c("p_name").alias("title"),
        (c("l_tax") > 0.045).alias("automatic_relist"),
        F.timestamp_add("SECOND", F.floor("o_totalprice"), c("o_orderdate")).alias("date_created"),
        F.when(c("l_quantity") < 50, c("l_shipdate")).alias("stop_time"),
        F.lower("o_orderstatus").alias("status"),
        c("p_size").cast("bigint").alias("initial_quantity"),
        c("o_orderdate").alias("start_time"),
        c("l_quantity").cast("bigint").alias("sold_quantity"),
        F.greatest(c("p_size") - c("l_linenumber"), F.lit(0)).cast("bigint").alias("available_quantity"),
    )


LISTING_SQL = """listing AS (
  SELECT lower(r_name) AS country,
    CASE WHEN NOT (l_discount < 0.005 AND l_tax < 0.015) THEN lower(n_name) END AS state,
    lower(n_name || '-' || c_mktsegment) AS city,
    CASE WHEN (l_returnflag = 'R') = (p_size < 28) THEN 'used' ELSE 'new' END AS target,
    p_retailprice AS price, l_quantity > 25 AS local_pickup, l_discount > 0.055 AS free_shipping,
    CASE WHEN l_quantity < 2 THEN 'custom' ELSE lower(l_linestatus) END AS shipping_mode,
    l_suppkey AS seller_id, lower(r_name) AS site_id, lower(o_orderpriority) AS listing_type,
    CASE WHEN l_tax >= 0.005 THEN lower(p_brand) END AS attribute_group_id,
    CASE WHEN l_tax >= 0.005 THEN lower(p_type || ' ' || p_brand) END AS attribute_name,
    CASE WHEN l_tax >= 0.005 THEN lower(p_type) END AS attribute_group,
    CASE WHEN l_tax >= 0.005 THEN lower(p_brand || '-' || p_size::varchar) END AS attribute_id,
    lower(p_type) AS buying_mode, lower(p_brand || '/' || p_type) AS category_id,
    l_shipdate + to_seconds(floor(l_extendedprice)::bigint) AS last_updated,
    l_partkey AS product_id, l_tax < 0.075 AS accepts_mercadopago,
    CASE WHEN l_discount > 0.095 THEN 'usd' ELSE 'ars' END AS currency, p_name AS title,
    l_tax > 0.045 AS automatic_relist,
    o_orderdate + to_seconds(floor(o_totalprice)::bigint) AS date_created,
    CASE WHEN l_quantity < 50 THEN l_shipdate END AS stop_time, lower(o_orderstatus) AS status,
    p_size::bigint AS initial_quantity, o_orderdate AS start_time,
    floor(l_quantity)::bigint AS sold_quantity,
    greatest(p_size - l_linenumber, 0)::bigint AS available_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def listing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested listing documents, one per order, in the raw input shape.

    Lists are absent, empty, single or double depending on the order's own
    columns; every list is built from its row, never gathered across rows.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        F.broadcast(places(spark, sf_dir)), customer.c_nationkey == F.col("n_nationkey")
    )
    shaped = joined.selectExpr(*[f"{text} AS {name}" for name, text in DOCUMENT_FIELDS.items()])
    return shaped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LISTING_SCHEMA.fields]
    )


DOCUMENT_FIELDS = {
    "id": "concat('L', o_orderkey)",
    "title": "concat('  Lot ', c_mktsegment, ' ', o_orderpriority, '\\t')",
    "condition": "CASE WHEN o_orderstatus = 'F' THEN 'Used' WHEN o_totalprice > 250000 THEN 'New' ELSE ' new ' END",
    "base_price": "o_totalprice",
    "price": "o_totalprice",
    "initial_quantity": "cast(floor(o_totalprice / 1000) as bigint)",
    "sold_quantity": "cast(floor(o_totalprice / 9000) as bigint)",
    "available_quantity": "cast(floor(o_totalprice / 1000) as bigint) - cast(floor(o_totalprice / 9000) as bigint)",
    "seller_id": "o_custkey",
    "site_id": "r_name",
    "category_id": "c_mktsegment",
    "currency_id": "CASE WHEN o_totalprice > 480000 THEN 'USD' ELSE 'ARS' END",
    "listing_type_id": "o_orderpriority",
    "buying_mode": "CASE WHEN o_orderstatus = 'P' THEN 'auction' ELSE 'buy_it_now' END",
    "status": "CASE WHEN o_totalprice > 400000 THEN 'Paused' ELSE 'active' END",
    "accepts_mercadopago": "c_acctbal > 0",
    "automatic_relist": "o_totalprice > 300000",
    "date_created": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "last_updated": (
        "concat('\"', date_format(timestampadd(SECOND, cast(floor(o_totalprice) as int), o_orderdate), "
        "\"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\"), '\"')"
    ),
    "start_time": "unix_millis(cast(o_orderdate as timestamp)) + 10 * cast(floor(o_totalprice) as bigint)",
    "stop_time": (
        "CASE WHEN o_totalprice < 20000 THEN 'open end' ELSE "
        "date_format(timestampadd(DAY, 60, o_orderdate), 'yyyy-MM-dd HH:mm:ss') END"
    ),
    "sub_status": "CASE WHEN o_orderstatus = 'P' THEN array('suspended', o_orderpriority) "
    "WHEN o_orderstatus = 'O' THEN array() END",
    "deal_ids": "CASE WHEN o_totalprice > 300000 THEN array('D1', cast(null as string), 'D2') "
    "ELSE cast(array() as array<string>) END",
    "tags": "array(c_mktsegment, 'dragged')",
    "descriptions": "array(concat('D', o_orderkey))",
    "permalink": "concat('item/', o_orderkey)",
    "thumbnail": "concat('thumb/', o_orderkey)",
    "seller_address": "named_struct('country', named_struct('id', r_name, 'name', concat(r_name, ' land')), "
    "'state', named_struct('id', n_name, 'name', n_name), "
    "'city', named_struct('id', c_mktsegment, 'name', CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE "
    "concat(n_name, ' ', c_mktsegment) END))",
    "shipping": "named_struct('local_pick_up', c_acctbal > 4000, 'free_shipping', o_totalprice > 350000, "
    "'mode', CASE WHEN o_orderstatus = 'O' THEN 'me2' ELSE 'not_specified' END, 'free_methods', "
    "CASE WHEN o_totalprice > 350000 THEN array(named_struct('id', cast(73328 as bigint), 'rule', "
    "named_struct('value', cast(null as string), 'free_mode', 'country'))) "
    "WHEN o_totalprice > 330000 THEN array() END)",
    "non_mercado_pago_payment_methods": "CASE WHEN o_orderpriority = '1-URGENT' THEN "
    "array(named_struct('id', 'CASH', 'description', 'cash', 'type', 'G'), "
    "named_struct('id', 'WIRE', 'description', 'transfer', 'type', 'N')) "
    "WHEN o_orderpriority = '2-HIGH' THEN array() "
    "WHEN o_orderpriority = '3-MEDIUM' THEN array(named_struct('id', 'CASH', 'description', 'cash', 'type', 'G')) "
    "END",
    "variations": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN array("
    "named_struct('id', cast(1 as bigint), 'attribute_combinations', "
    "array(named_struct('id', 'C', 'name', 'Color', 'value_id', '1', 'value_name', 'Red'), "
    "named_struct('id', 'S', 'name', 'Size', 'value_id', '2', 'value_name', 'L'))), "
    "named_struct('id', cast(2 as bigint), 'attribute_combinations', "
    "array(named_struct('id', 'C', 'name', 'Color', 'value_id', '3', 'value_name', 'Blue')))) "
    "WHEN c_mktsegment = 'MACHINERY' THEN array() END",
    "attributes": "CASE WHEN o_orderstatus = 'O' THEN array("
    "named_struct('id', c_mktsegment, 'name', 'Brand', 'attribute_group_id', 'MAIN', "
    "'attribute_group_name', 'Principal', 'value_id', '10', 'value_name', r_name), "
    "named_struct('id', 'SEASON', 'name', 'Season', 'attribute_group_id', 'DFLT', "
    "'attribute_group_name', 'Other', 'value_id', '11', 'value_name', 'null')) "
    "WHEN o_totalprice > 60000 THEN array(named_struct('id', c_mktsegment, 'name', 'Brand', "
    "'attribute_group_id', 'MAIN', 'attribute_group_name', 'Principal', 'value_id', '10', 'value_name', r_name)) "
    "ELSE array() END",
    "pictures": "CASE WHEN o_totalprice > 100000 THEN array("
    "named_struct('id', concat('P', o_orderkey, 'a'), 'url', 'u/a', 'size', '500x500'), "
    "named_struct('id', concat('P', o_orderkey, 'b'), 'url', 'u/b', 'size', '200x200')) "
    "ELSE array(named_struct('id', concat('P', o_orderkey, 'a'), 'url', 'u/a', 'size', '500x500')) END",
}


DOCUMENT_SQL = """docs AS (
  SELECT 'L' || o_orderkey::varchar AS id,
    '  Lot ' || c_mktsegment || ' ' || o_orderpriority || chr(9) AS title,
    CASE WHEN o_orderstatus = 'F' THEN 'Used' WHEN o_totalprice > 250000 THEN 'New' ELSE ' new ' END AS condition,
    o_totalprice AS base_price, floor(o_totalprice / 1000)::bigint AS initial_quantity,
    floor(o_totalprice / 9000)::bigint AS sold_quantity,
    floor(o_totalprice / 1000)::bigint - floor(o_totalprice / 9000)::bigint AS available_quantity,
    o_custkey AS seller_id, r_name AS site_id, c_mktsegment AS category_id,
    CASE WHEN o_totalprice > 480000 THEN 'USD' ELSE 'ARS' END AS currency_id,
    o_orderpriority AS listing_type_id,
    CASE WHEN o_orderstatus = 'P' THEN 'auction' ELSE 'buy_it_now' END AS buying_mode,
    CASE WHEN o_totalprice > 400000 THEN 'Paused' ELSE 'active' END AS status,
    c_acctbal > 0 AS accepts_mercadopago, o_totalprice > 300000 AS automatic_relist,
    o_orderdate AS date_created, o_orderdate + to_seconds(floor(o_totalprice)::bigint) AS last_updated,
    o_orderdate + to_milliseconds(10 * floor(o_totalprice)::bigint) AS start_time,
    CASE WHEN o_totalprice >= 20000 THEN o_orderdate + INTERVAL 60 DAY END AS stop_time,
    CASE WHEN o_orderstatus = 'P' THEN 'suspended,' || o_orderpriority WHEN o_orderstatus = 'O' THEN '' END AS sub_status,
    CASE WHEN o_totalprice > 300000 THEN 'D1,D2' ELSE '' END AS deal_ids,
    c_mktsegment || ',dragged' AS tags, 'D' || o_orderkey::varchar AS descriptions,
    r_name || ' land' AS country, n_name AS state,
    CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE n_name || ' ' || c_mktsegment END AS city,
    c_acctbal > 4000 AS local_pick_up, o_totalprice > 350000 AS free_shipping,
    CASE WHEN o_orderstatus = 'O' THEN 'me2' ELSE 'not_specified' END AS shipping_mode,
    CASE WHEN o_totalprice > 350000 THEN [{id: 73328::bigint, free_mode: 'country'}] END AS free_methods,
    CASE WHEN o_orderpriority = '1-URGENT' THEN ['CASH', 'WIRE'] WHEN o_orderpriority = '3-MEDIUM' THEN ['CASH'] END AS payments,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN
      [{id: 1::bigint, combinations: ['C', 'S']}, {id: 2::bigint, combinations: ['C']}] END AS variations,
    CASE WHEN o_orderstatus = 'O' THEN [
        {id: c_mktsegment, name: 'Brand', group_id: 'MAIN', group_name: 'Principal', value: r_name},
        {id: 'SEASON', name: 'Season', group_id: 'DFLT', group_name: 'Other', value: 'null'}]
      WHEN o_totalprice > 60000 THEN [
        {id: c_mktsegment, name: 'Brand', group_id: 'MAIN', group_name: 'Principal', value: r_name}] END AS attributes,
    CASE WHEN o_totalprice > 100000 THEN ['a', 'b'] ELSE ['a'] END AS pictures
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def unnest_sql(column: str, alias: str) -> str:
    """Unnest that keeps rows without elements."""
    return f"unnest(CASE WHEN len({column}) > 0 THEN {column} ELSE [NULL] END) AS {alias}"


FLAT_SQL = f"""flat_1 AS (SELECT *, {unnest_sql("payments", "payment")} FROM docs),
flat_2 AS (SELECT *, {unnest_sql("variations", "variation")} FROM flat_1),
flat_3 AS (SELECT *, {unnest_sql("attributes", "attribute")} FROM flat_2),
flat_4 AS (SELECT *, {unnest_sql("pictures", "picture")} FROM flat_3),
flat_5 AS (SELECT *, {unnest_sql("free_methods", "free_method")} FROM flat_4),
flat AS (SELECT *, {unnest_sql("variation.combinations", "combination")} FROM flat_5)"""
