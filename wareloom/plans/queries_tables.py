"""Entity tables, counts, duplicates, samples, calendar and business queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareloom.functions.columns import amount, hours_between
from wareloom.operators import counts as C
from wareloom.operators.entity import entity_aggregate, group_modes
from wareloom.operators.profile import basic_stats
from wareloom.operators.ranks import exact_quantiles
from wareloom.plans import business as B
from wareloom.plans.driver_tables import listing_rows, places, table
from wareloom.plans.registry import query, rounded
from wareloom.plans.sql_texts import entity_part, stored_columns, with_listing
from wareloom.schema import TIME_COLUMNS, WEEKDAY_LABELS, WEEKDAYS


def entities(spark, sf_dir, key="product_id", **options):
    return entity_aggregate(listing_rows(spark, sf_dir), key, **options)


for _level, _key in B.LEVELS.items():

    @query(
        f"a1_entity_{_level}",
        with_listing(f"SELECT {stored_columns(_key)} FROM entity", entity_part(_key)),
    )
    def _entity(spark, sf_dir, key=_key):
        return rounded(entities(spark, sf_dir, key))

    @query(
        f"b4_{_level}_table",
        with_listing(
            f"SELECT {_key}, condition, title, round(unit_price, 4) AS unit_price, total_quantity, "
            "last_updated, date_created, start_time, stop_time, round(total_amount, 4) AS total_amount FROM entity",
            entity_part(_key),
        ),
    )
    def _entity_with_helpers(spark, sf_dir, key=_key):
        table_ = entities(spark, sf_dir, key, modes=["condition", "title"], keep_helpers=True)
        return rounded(
            table_.select(
                key, "condition", "title", "unit_price", "total_quantity", *TIME_COLUMNS, "total_amount"
            )
        )


@query(
    "a1_entity_once_per_product",
    with_listing(
        """SELECT seller_id, sum(sold_quantity)::bigint AS total_quantity, sum(initial_quantity)::bigint AS stock_quantity
        FROM once GROUP BY seller_id""",
        """once AS (SELECT seller_id, product_id,
          first(sold_quantity ORDER BY last_updated NULLS FIRST, date_created NULLS FIRST, start_time NULLS FIRST,
            stop_time NULLS FIRST, price, sold_quantity, initial_quantity, available_quantity) AS sold_quantity,
          first(initial_quantity) AS initial_quantity
          FROM listing GROUP BY seller_id, product_id)""",
    ),
)
def _entity_grain(spark, sf_dir):
    once = entities(spark, sf_dir, "seller_id", grain="entity", modes=[], keep_helpers=True)
    return once.select("seller_id", "total_quantity", "stock_quantity")


@query(
    "a2_mode_nulls_counted",
    with_listing(
        """SELECT seller_id, first(attribute_group_id ORDER BY n DESC, attribute_group_id IS NULL, attribute_group_id)
           AS attribute_group_id FROM t GROUP BY seller_id""",
        "t AS (SELECT seller_id, attribute_group_id, count(*) n FROM listing GROUP BY ALL)",
    ),
)
def _mode_counted(spark, sf_dir):
    return group_modes(listing_rows(spark, sf_dir), "seller_id", {"attribute_group_id": "attribute_group_id"})


@query(
    "a2_mode_nulls_ignored",
    with_listing(
        """SELECT product_id, first(attribute_id ORDER BY n DESC, attribute_id) AS attribute_id
           FROM t GROUP BY product_id""",
        "t AS (SELECT product_id, attribute_id, count(*) n FROM listing WHERE attribute_id IS NOT NULL GROUP BY ALL)",
    ),
)
def _mode_ignored(spark, sf_dir):
    return group_modes(listing_rows(spark, sf_dir), "product_id", {"attribute_id": "attribute_id"}, nulls="ignore")


@query(
    "a3_first_values",
    with_listing(
        "SELECT site_id, unit_price, last_updated, date_created, start_time, stop_time FROM entity",
        entity_part("site_id"),
    ),
)
def _firsts(spark, sf_dir):
    return entities(spark, sf_dir, "site_id", modes=[], keep_helpers=True).select(
        "site_id", "unit_price", *TIME_COLUMNS
    )


@query(
    "a4_sums_null_as_zero",
    with_listing(
        "SELECT listing_type, coalesce(sum(CASE WHEN listing_type <> '1-urgent' THEN sold_quantity END), 0)::bigint AS total_quantity, "
        "sum(initial_quantity)::bigint AS stock_quantity FROM listing GROUP BY 1"
    ),
)
def _sums(spark, sf_dir):
    """A type without any quantity sums to zero."""
    rows = listing_rows(spark, sf_dir).withColumn(
        "sold_quantity", F.when(F.col("listing_type") != "1-urgent", F.col("sold_quantity"))
    )
    sums = entity_aggregate(rows, "listing_type", modes=[], keep_helpers=True, ordered=False)
    return sums.select("listing_type", "total_quantity", "stock_quantity")


@query(
    "a5_null_group",
    with_listing("SELECT state, sum(sold_quantity)::bigint AS total_quantity FROM listing GROUP BY state"),
)
def _null_group(spark, sf_dir):
    return entities(spark, sf_dir, "state", modes=[], keep_helpers=True).select("state", "total_quantity")


CONFLICT = "SELECT {key}, count(DISTINCT {c}) + max(({c} IS NULL)::int) AS {out} FROM listing GROUP BY 1 HAVING {out} > 1"


@query(
    "a6_conditions_per_product",
    with_listing(CONFLICT.format(key="product_id", c="target", out="n_conditions")),
)
def _conditions(spark, sf_dir):
    return C.conflicting_keys(listing_rows(spark, sf_dir), "product_id", "target", "n_conditions")


@query(
    "a6_states_per_seller_null_is_a_value",
    with_listing(CONFLICT.format(key="seller_id", c="state", out="n_states")),
)
def _states(spark, sf_dir):
    return C.conflicting_keys(listing_rows(spark, sf_dir), "seller_id", "state", "n_states")


@query("a7_rows_per_product", with_listing("SELECT product_id, count(*) AS n FROM listing GROUP BY 1"))
def _rows_per_product(spark, sf_dir):
    return C.count_rows(listing_rows(spark, sf_dir), ["product_id"])


@query(
    "a7_rows_per_product_title",
    with_listing("SELECT product_id, title, count(*) AS n FROM listing GROUP BY 1, 2"),
)
def _rows_per_title(spark, sf_dir):
    return C.count_rows(listing_rows(spark, sf_dir), ["product_id", "title"])


PLACE_COLUMNS = ["seller_id", "target", "listing_type", "shipping_mode", "currency"]


@query(
    "a8_repeated_rows",
    with_listing(f"SELECT {', '.join(PLACE_COLUMNS)}, count(*) AS n FROM listing GROUP BY ALL HAVING count(*) > 1"),
)
def _repeated(spark, sf_dir):
    return C.repeated_rows(listing_rows(spark, sf_dir).select(*PLACE_COLUMNS))


@query(
    "a8_number_of_repeated_groups",
    with_listing(
        "SELECT count(*) AS n_groups FROM (SELECT 1 FROM listing GROUP BY "
        "product_id, seller_id, target, state, listing_type HAVING count(*) > 1)"
    ),
)
def _repeated_groups(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).select("product_id", "seller_id", "target", "state", "listing_type")
    return C.repeated_rows(rows).agg(F.count("*").alias("n_groups"))


@query(
    "a9_value_counts",
    with_listing("SELECT listing_type, count(*) AS n FROM listing GROUP BY 1"),
)
def _value_counts(spark, sf_dir):
    return C.value_counts(listing_rows(spark, sf_dir), "listing_type")


@query(
    "a9_value_shares",
    with_listing(
        "SELECT state, count(*) AS n, round(count(*) / (SELECT count(state) FROM listing), 10) AS share "
        "FROM listing WHERE state IS NOT NULL GROUP BY 1"
    ),
)
def _value_shares(spark, sf_dir):
    return rounded(C.value_counts(listing_rows(spark, sf_dir), "state", normalize=True), 10)


STAT_COLUMNS = ["price", "sold_quantity", "initial_quantity", "available_quantity"]


@query(
    "a10_stats_by_target",
    with_listing(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, target, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"count({c}) AS n, count(DISTINCT {c}) AS n_unique FROM listing GROUP BY target"
            for c in STAT_COLUMNS
        )
    ),
)
def _grouped_stats(spark, sf_dir):
    return rounded(C.grouped_stats(listing_rows(spark, sf_dir), "target", STAT_COLUMNS))


@query(
    "a11_scalar_aggregates",
    """SELECT round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
       min(l_extendedprice) AS low, max(l_extendedprice) AS high,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.9), 4) AS q90 FROM lineitem""",
)
def _scalars(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    stats = basic_stats(line, ["l_extendedprice"]).drop("n")
    quantiles = exact_quantiles(line, ["l_extendedprice"], [0.5, 0.9])
    return rounded(
        stats.join(F.broadcast(quantiles), "variable")
        .drop("variable")
        .withColumnsRenamed({"q_0": "median", "q_1": "q90"})
    )


@query(
    "a12_listing_type_by_target",
    with_listing("SELECT listing_type, target, count(*) AS n FROM listing GROUP BY 1, 2"),
)
def _two_way(spark, sf_dir):
    return C.cross_counts(listing_rows(spark, sf_dir), "listing_type", "target")


@query(
    "a13_contingency_without_nulls",
    with_listing(
        "SELECT state, attribute_group, count(*) AS n FROM listing "
        "WHERE state IS NOT NULL AND attribute_group IS NOT NULL GROUP BY 1, 2"
    ),
)
def _contingency(spark, sf_dir):
    return C.cross_counts(listing_rows(spark, sf_dir), "state", "attribute_group")


DAYS_SQL = (
    "days(position, weekday, label) AS (VALUES "
    + ", ".join(f"({i}, '{d}', '{WEEKDAY_LABELS[d]}')" for i, d in enumerate(WEEKDAYS))
    + ")"
)


def day_hour_sql(source: str, columns: list[str]) -> str:
    hours = ", ".join(f"sum((hour(moment) = {h})::int)::bigint AS h{h:02d}" for h in range(24))
    times = " UNION ALL ".join(f"SELECT '{c}' AS time_column, {c} AS moment FROM {source}" for c in columns)
    names = ", ".join(f"'{c}'" for c in columns)
    return f"""SELECT d.time_column, d.position::int AS position, d.weekday, t.* EXCLUDE (time_column, weekday)
      FROM (SELECT unnest([{names}]) AS time_column, position, weekday FROM days) d
      LEFT JOIN (SELECT time_column, dayname(moment) AS weekday, {hours} FROM ({times})
        WHERE moment IS NOT NULL GROUP BY 1, 2) t
      ON d.time_column = t.time_column AND d.weekday = t.weekday"""


@query("a14_weekday_hour_of_events", "WITH " + DAYS_SQL + day_hour_sql("events", ["ts"]))
def _event_calendar(spark, sf_dir):
    return C.weekday_hours(table(spark, sf_dir, "events"), ["ts"])


@query(
    "r2_pivot_status_by_listing_type",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
       count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""",
)
def _pivot(spark, sf_dir):
    pivoted = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )
    return pivoted.withColumnsRenamed({"F": "f", "O": "o", "P": "p"})


@query(
    "r3_all_weekdays",
    "WITH "
    + DAYS_SQL
    + """SELECT 'o_orderdate' AS time_column, label, position::int AS position, coalesce(n, 0) AS n FROM days
      LEFT JOIN (SELECT dayname(o_orderdate) AS weekday, count(*) AS n FROM orders GROUP BY 1) USING (weekday)""",
)
def _weekdays(spark, sf_dir):
    return C.weekday_counts(table(spark, sf_dir, "orders"), ["o_orderdate"])


@query(
    "r1_missing_report",
    with_listing(
        "SELECT * FROM (UNPIVOT (SELECT "
        + ", ".join(
            f"round(avg(({c} IS NULL)::int), 4) AS {c}"
            for c in ["state", "city", "attribute_group_id", "attribute_id", "stop_time", "price"]
        )
        + " FROM listing) ON COLUMNS(*) INTO NAME variable VALUE ratio)"
    ),
)
def _missing(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).select(
        "state", "city", "attribute_group_id", "attribute_id", "stop_time", "price"
    )
    return rounded(C.missing_report(rows))


@query(
    "r4_transposed_stats",
    with_listing(
        " UNION ALL ".join(
            f"SELECT '{c}' AS variable, round(avg({c}) FILTER (target = 'new'), 4) AS mean_new, "
            f"round(avg({c}) FILTER (target = 'used'), 4) AS mean_used FROM listing"
            for c in STAT_COLUMNS
        )
    ),
)
def _transposed(spark, sf_dir):
    stats = C.grouped_stats(listing_rows(spark, sf_dir), "target", STAT_COLUMNS)
    wide = stats.groupBy("variable").pivot("target", ["new", "used"]).agg(F.max("mean"))
    return rounded(wide.withColumnsRenamed({"new": "mean_new", "used": "mean_used"}))


@query(
    "w1_rows_with_repeated_key",
    """SELECT event_id, user_id, event_type FROM events
       QUALIFY count(*) OVER (PARTITION BY user_id) > 1""",
)
def _repeated_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return C.rows_with_repeated_key(events, "user_id")


@query(
    "w1_rows_with_repeated_line",
    """SELECT line, l_suppkey, l_quantity FROM (SELECT l_orderkey * 8 + l_linenumber AS line, * FROM lineitem)
       QUALIFY count(*) OVER (PARTITION BY line) > 1""",
)
def _repeated_lines(spark, sf_dir):
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    rows = table(spark, sf_dir, "lineitem").select(line, "l_suppkey", "l_quantity")
    return C.rows_with_repeated_key(rows, "line")


@query(
    "o1_ordered_by_amount",
    with_listing(
        "SELECT product_id, round(total_amount, 4) AS total_amount FROM entity ORDER BY total_amount DESC NULLS FIRST",
        entity_part("product_id"),
    ),
)
def _ordered(spark, sf_dir):
    return rounded(entities(spark, sf_dir, modes=[]).select("product_id", "total_amount"))


TOP_SQL = with_listing(
    "SELECT product_id, title, round(total_amount, 4) AS total_amount FROM entity "
    "ORDER BY entity.total_amount DESC NULLS FIRST, product_id LIMIT 10",
    entity_part("product_id"),
)


@query(
    "o2_top_products",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10000 <> 7 THEN o_totalprice END AS amount FROM orders "
    "ORDER BY amount DESC NULLS FIRST, o_orderkey LIMIT 10",
)
def _top(spark, sf_dir):
    """Missing amounts come first."""
    amount = F.when(F.col("o_orderkey") % 10000 != 7, F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", amount.alias("amount"))
    return C.top_rows(orders, "amount", "o_orderkey", 10)


@query("b9_top_revenue_titles", TOP_SQL)
def _top_titles(spark, sf_dir):
    return rounded(B.top_revenue(listing_rows(spark, sf_dir)))


@query(
    "o3_first_values_of_column",
    """SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_custkey LIMIT 10""",
)
def _limited(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").where(F.col("c_acctbal").isNotNull())
    return rows.select("c_custkey", "c_acctbal").orderBy("c_custkey").limit(10)


@query(
    "o4_seeded_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('25:' || o_orderkey::varchar), o_orderkey LIMIT 50",
)
def _sampled(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return C.sample_rows(orders, "o_orderkey", 50, 25)


@query(
    "o5_first_row",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1",
)
def _first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return C.first_row(orders, ["o_orderdate", "o_orderkey"])


@query(
    "o6_ordered_shares",
    "SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 10) AS share "
    "FROM events GROUP BY 1 ORDER BY n DESC",
)
def _ordered_shares(spark, sf_dir):
    shares = C.value_counts(table(spark, sf_dir, "events"), "event_type", normalize=True)
    return rounded(shares.orderBy(F.col("share").desc(), "event_type"), 10)


@query(
    "u1_distinct_rows",
    """SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, [l_linestatus, l_returnflag]::varchar AS flags FROM lineitem""",
)
def _distinct(spark, sf_dir):
    flags = F.array("l_linestatus", "l_returnflag").alias("flags")
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", flags)
    distinct = rows.dropDuplicates()
    text = F.concat(F.lit("["), F.array_join("flags", ", "), F.lit("]"))
    return distinct.withColumn("flags", text)


@query(
    "d1_derived_columns",
    with_listing(
        """SELECT product_id, seller_id, round(price * sold_quantity, 4) AS amount,
        round(date_sub('second', date_created, last_updated) / 3600.0, 4) AS date_difference_hr,
        round(date_sub('second', start_time, stop_time) / 3600.0, 4) AS time_difference_hr FROM listing"""
    ),
)
def _derived(spark, sf_dir):
    return rounded(
        listing_rows(spark, sf_dir).select(
            "product_id",
            "seller_id",
            amount(F.col("price"), F.col("sold_quantity")).alias("amount"),
            hours_between(F.col("date_created"), F.col("last_updated")).alias("date_difference_hr"),
            hours_between(F.col("start_time"), F.col("stop_time")).alias("time_difference_hr"),
        )
    )


@query(
    "b1_products_with_several_updates",
    with_listing(CONFLICT.format(key="product_id", c="last_updated", out="n_updates")),
)
def _updates(spark, sf_dir):
    return C.conflicting_keys(listing_rows(spark, sf_dir), "product_id", "last_updated", "n_updates")


@query(
    "b2_contradiction",
    with_listing("SELECT product_id, target FROM listing WHERE target = 'new' AND target = 'used'"),
)
def _contradiction(spark, sf_dir):
    rows = listing_rows(spark, sf_dir)
    return rows.where((F.col("target") == "new") & (F.col("target") == "used")).select("product_id", "target")


CONSTANT = ["price", "initial_quantity", "sold_quantity", "available_quantity"]


@query(
    "b3_varying_values_per_product",
    with_listing(
        "SELECT product_id, "
        + ", ".join(f"count(DISTINCT {c}) AS n_{c}" for c in CONSTANT)
        + " FROM listing GROUP BY 1 HAVING greatest("
        + ", ".join(f"count(DISTINCT {c})" for c in CONSTANT)
        + ") > 1"
    ),
)
def _varying(spark, sf_dir):
    return C.varying_keys(listing_rows(spark, sf_dir), "product_id", CONSTANT)


def share_sql() -> str:
    parts = [entity_part(key, f"by_{level}") for level, key in B.LEVELS.items()]
    body = " UNION ALL ".join(
        f"SELECT '{level}' AS level, condition, count(*) AS n, "
        f"round(count(*) / (SELECT count(*) FROM by_{level}), 10) AS share FROM by_{level} GROUP BY condition"
        for level in B.LEVELS
    )
    return with_listing(body, *parts)


@query("b5_condition_shares", share_sql())
def _shares(spark, sf_dir):
    return rounded(B.condition_shares(listing_rows(spark, sf_dir)), 10)


@query(
    "b6_log_amounts",
    with_listing(
        "SELECT product_id, condition, round(total_amount, 4) AS total_amount, "
        "round(CASE WHEN total_amount > 0 THEN ln(total_amount) END, 4) AS log_amount FROM entity",
        entity_part("product_id"),
    ),
)
def _amounts(spark, sf_dir):
    return rounded(B.product_amounts(listing_rows(spark, sf_dir)))


def density_sql(values: str, by: str, points: int = 200, bins: int = 2048) -> str:
    """Gaussian density over the rows ``(by, value)`` of the CTE ``values``, counted in bins first."""
    return f"""spans AS (
  SELECT {by}, count(*) AS total, stddev_samp(value) * pow(count(*), -0.2) AS width, min(value) AS low, max(value) AS high,
    (max(value) - min(value)) / {bins} AS bin_width FROM {values} GROUP BY {by}),
binned AS (
  SELECT v.{by}, low + (least(floor((value - low) / bin_width), {bins - 1}) + 0.5) * bin_width AS value, count(*) AS n
  FROM {values} v JOIN spans s ON v.{by} = s.{by} GROUP BY 1, 2),
grid AS (
  SELECT {by}, total, width, point, low - 3 * width + point * ((high - low + 6 * width) / {points - 1}) AS x
  FROM spans, (SELECT unnest(range({points}))::int AS point)),
density AS (
  SELECT g.{by}, point, round(x, 4) AS x,
    round(sum(n * exp(-pow((x - value) / width, 2) / 2)) / any_value(total * width * sqrt(2 * pi())), 4) AS density
  FROM grid g JOIN binned v ON g.{by} = v.{by} GROUP BY g.{by}, point, x)"""


@query(
    "b6_amount_density",
    with_listing(
        "SELECT condition, point, x, density FROM density",
        entity_part("product_id"),
        "amounts AS (SELECT condition, ln(total_amount) AS value FROM entity WHERE total_amount > 0)",
        density_sql("amounts", "condition"),
    ),
)
def _amount_density(spark, sf_dir):
    return rounded(B.amount_density(listing_rows(spark, sf_dir)))


def weekday_sql(source: str, columns: list[str]) -> str:
    times = " UNION ALL ".join(
        f"SELECT '{c}' AS time_column, dayname({c}) AS weekday, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    )
    names = ", ".join(f"'{c}'" for c in columns)
    return f"""SELECT d.time_column, d.label, d.position::int AS position, coalesce(n, 0) AS n
      FROM (SELECT unnest([{names}]) AS time_column, * FROM days) d
      LEFT JOIN ({times}) t ON d.time_column = t.time_column AND d.weekday = t.weekday"""


NEW_SQL = "fresh AS (SELECT * FROM entity WHERE condition = 'new')"


@query(
    "b7_new_by_weekday",
    with_listing(weekday_sql("fresh", TIME_COLUMNS), entity_part("product_id"), NEW_SQL, DAYS_SQL),
)
def _new_weekday(spark, sf_dir):
    return B.new_by_weekday(listing_rows(spark, sf_dir))


@query(
    "b8_new_by_weekday_hour",
    with_listing(day_hour_sql("fresh", TIME_COLUMNS), entity_part("product_id"), NEW_SQL, DAYS_SQL),
)
def _new_weekday_hour(spark, sf_dir):
    return B.new_by_weekday_hour(listing_rows(spark, sf_dir))


@query(
    "b10_condition_by_state",
    with_listing(
        "SELECT state, condition, count(*) AS n FROM entity WHERE state IS NOT NULL GROUP BY 1, 2",
        entity_part("product_id"),
    ),
)
def _by_state(spark, sf_dir):
    products = entities(spark, sf_dir, modes=["condition", "state"], ordered=False)
    return C.cross_counts(products, "state", "condition")


@query(
    "b10_condition_by_currency",
    with_listing("SELECT currency, target AS condition, count(*) AS n FROM listing GROUP BY 1, 2"),
)
def _by_currency(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).withColumnRenamed("target", "condition")
    return C.cross_counts(rows, "currency", "condition")


@query(
    "k5_filters",
    with_listing(
        "SELECT product_id, seller_id, sold_quantity, price FROM listing WHERE target = 'new' AND sold_quantity >= 40"
    ),
)
def _filters(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).where((F.col("target") == "new") & (F.col("sold_quantity") >= 40))
    return rows.select("product_id", "seller_id", "sold_quantity", "price")


@query("k6_projection", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def _projection(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")


@query(
    "k7_null_predicates",
    with_listing(
        "SELECT target, round(avg((state IS NULL)::int), 4) AS null_ratio, count(*) FILTER (state IS NOT NULL) AS n_filled "
        "FROM listing GROUP BY 1"
    ),
)
def _null_predicates(spark, sf_dir):
    missing = F.col("state").isNull()
    return rounded(
        listing_rows(spark, sf_dir)
        .groupBy("target")
        .agg(F.avg(missing.cast("double")).alias("null_ratio"), F.count_if(~missing).alias("n_filled"))
    )


@query("s3_read_places", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _places(spark, sf_dir):
    return places(spark, sf_dir).select("n_nationkey", "n_name", "r_name")
