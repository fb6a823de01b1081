"""Statistical profiles and association measures."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from wareloom.operators import association as A
from wareloom.operators import counts as C
from wareloom.operators import profile as P
from wareloom.operators.ranks import empirical_cdf, value_counts_long
from wareloom.plans.driver_tables import listing_rows, table
from wareloom.plans.queries_tables import density_sql
from wareloom.plans.registry import query, rounded
from wareloom.plans.sql_texts import with_listing

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def line(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*NUMBERS)


def each(template: str, columns=NUMBERS, glue: str = " UNION ALL ") -> str:
    return glue.join(template.format(c=c) for c in columns)


MISSING = ["state", "city", "attribute_group_id", "stop_time", "title"]


@query(
    "x1_missing_profile",
    with_listing(
        "SELECT variable, round(ratio, 4) AS ratio, ratio > 1/3 AS above_third FROM ("
        + each("SELECT '{c}' AS variable, avg(({c} IS NULL)::int) AS ratio FROM listing", MISSING)
        + ") WHERE ratio > 0"
    ),
)
def _missing(spark, sf_dir):
    rows = listing_rows(spark, sf_dir).select(*MISSING)
    return rounded(C.missing_report(rows, only_missing=True))


@query(
    "x2_class_distribution",
    with_listing(
        "SELECT target, count(*) AS n, round(count(*) / (SELECT count(*) FROM listing), 10) AS share FROM listing GROUP BY 1"
    ),
)
def _classes(spark, sf_dir):
    return rounded(C.value_counts(listing_rows(spark, sf_dir), "target", normalize=True), 10)


CORR = ["price", "sold_quantity", "initial_quantity", "available_quantity", "partly"]
CORR_SQL = "corr_rows AS (SELECT *, CASE WHEN free_shipping THEN sold_quantity + initial_quantity END AS partly FROM listing)"


@query(
    "x3_correlation_matrix",
    with_listing(
        " UNION ALL ".join(
            f"SELECT '{x}' AS x, '{y}' AS y, "
            + ("1.0::double" if x == y else f"round(corr({x}, {y}), 4)")
            + " AS corr FROM corr_rows HAVING count(*) > 0"
            for x in CORR
            for y in CORR
        ),
        CORR_SQL,
    ),
)
def _correlations(spark, sf_dir):
    partly = F.when(F.col("free_shipping"), F.col("sold_quantity") + F.col("initial_quantity"))
    return rounded(A.corr_matrix(listing_rows(spark, sf_dir).withColumn("partly", partly), CORR))


@query(
    "x3_correlation_of_constant",
    "SELECT 'l_quantity' AS x, 'fixed' AS y, NULL::double AS corr FROM lineitem HAVING count(*) > 0",
)
def _constant_correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", F.lit(1.0).alias("fixed"))
    return A.corr_pairs(rows, ["l_quantity", "fixed"])


def cramers_sql(x: str, y: str, source: str = "listing") -> str:
    """Textbook form over the full table, empty cells included."""
    return f"""SELECT '{x}' AS x, '{y}' AS y, (
      WITH cells AS (SELECT {x}::varchar AS vx, {y}::varchar AS vy, count(*)::double AS n FROM {source}
          WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT vx, sum(n) AS rn FROM cells GROUP BY 1), c AS (SELECT vy, sum(n) AS cn FROM cells GROUP BY 1),
        s AS (SELECT (SELECT sum(n) FROM cells) AS n, (SELECT count(*) FROM r) AS r, (SELECT count(*) FROM c) AS k),
        full_table AS (SELECT coalesce(cells.n, 0) AS o, rn * cn / s.n AS e, s.r AS nr, s.k AS nk FROM r, c, s
          LEFT JOIN cells ON cells.vx = r.vx AND cells.vy = c.vy),
        chi AS (SELECT sum(CASE WHEN nr = 2 AND nk = 2 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e
          ELSE pow(o - e, 2) / e END) AS chi2 FROM full_table)
      SELECT CASE WHEN least(k - pow(k - 1, 2) / (n - 1) - 1, r - pow(r - 1, 2) / (n - 1) - 1) = 0 THEN 0.0 ELSE
        sqrt(greatest(0, chi2 / n - (k - 1) * (r - 1) / (n - 1)) /
          least(k - pow(k - 1, 2) / (n - 1) - 1, r - pow(r - 1, 2) / (n - 1) - 1)) END FROM s, chi) AS v"""


CRAMERS = ["target", "attribute_group", "listing_type", "free_shipping", "currency", "country", "site_id"]


@query(
    "x4_cramers_v",
    with_listing(f"SELECT x, y, round(v, 4) AS v FROM ({cramers_sql('target', 'attribute_group')})"),
)
def _cramers(spark, sf_dir):
    return rounded(A.cramers_v(listing_rows(spark, sf_dir), ["target", "attribute_group"]))


@query(
    "x4_cramers_v_two_by_two",
    with_listing(f"SELECT x, y, round(v, 4) AS v FROM ({cramers_sql('free_shipping', 'currency')})"),
)
def _cramers_yates(spark, sf_dir):
    return rounded(A.cramers_v(listing_rows(spark, sf_dir), ["free_shipping", "currency"]))


@query(
    "x4_cramers_v_of_constant",
    "WITH one AS (SELECT o_orderstatus, 'ars' AS currency FROM orders) "
    f"SELECT x, y, v::double AS v FROM ({cramers_sql('o_orderstatus', 'currency', 'one')})",
)
def _cramers_constant(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", F.lit("ars").alias("currency"))
    return A.cramers_v(rows, ["o_orderstatus", "currency"])


@query(
    "x5_cramers_v_matrix",
    with_listing(
        "SELECT x, y, round(v, 4) AS v FROM pairs UNION ALL SELECT y, x, round(v, 4) FROM pairs UNION ALL "
        + each("SELECT '{c}', '{c}', 1.0::double", CRAMERS),
        "pairs AS (" + " UNION ALL ".join(cramers_sql(x, y) for x, y in combinations(CRAMERS, 2)) + ")",
    ),
)
def _cramers_matrix(spark, sf_dir):
    return rounded(A.cramers_v_matrix(listing_rows(spark, sf_dir), CRAMERS))


@query(
    "x6_histogram",
    each(
        """SELECT '{c}' AS variable, b AS bin, round(low + b * (high - low) / 25, 4) AS bin_start,
      round(low + (b + 1) * (high - low) / 25, 4) AS bin_end, coalesce(n, 0) AS n, round(mean, 4) AS mean,
      round(median, 4) AS median
      FROM (SELECT min({c}) AS low, max({c}) AS high, avg({c}) AS mean, quantile_cont({c}, 0.5) AS median FROM lineitem)
      CROSS JOIN (SELECT unnest(range(25))::int AS b)
      LEFT JOIN (SELECT least(floor(({c} - low) * 25 / (high - low)), 24)::int AS bin, count(*) AS n FROM lineitem,
        (SELECT min({c}) AS low, max({c}) AS high FROM lineitem) GROUP BY 1) ON b = bin"""
    ),
)
def _histogram(spark, sf_dir):
    return rounded(P.histogram(line(spark, sf_dir), NUMBERS))


@query(
    "x7_empirical_cdf",
    each(
        """SELECT '{c}' AS variable, {c}::double AS value, count(*) AS n,
      (sum(count(*)) OVER (ORDER BY {c}))::bigint AS cum,
      round(sum(count(*)) OVER (ORDER BY {c}) / sum(count(*)) OVER (), 10) AS share FROM lineitem GROUP BY {c}"""
    ),
)
def _cdf(spark, sf_dir):
    return rounded(empirical_cdf(line(spark, sf_dir), NUMBERS), 10)


# The distribution function by Simpson's rule, since DuckDB has no error function.
@query(
    "x8_normal_reference",
    "SELECT variable, point, round(x, 4) AS x, round(exp(-z * z / 2) / (std * sqrt(2 * pi())), 4) AS pdf, "
    "round(0.5 + (SELECT sum((CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
    "* exp(-pow(z * i / 400, 2) / 2)) FROM (SELECT unnest(range(401)) AS i)) * z / 1200 / sqrt(2 * pi()), 4) AS cdf FROM ("
    + each(
        """SELECT '{c}' AS variable, point, low + (high - low) * point / 49 AS x, std,
      (low + (high - low) * point / 49 - mean) / std AS z FROM (SELECT min({c}) AS low, max({c}) AS high, avg({c}) AS mean,
      stddev_samp({c}) AS std FROM lineitem) CROSS JOIN (SELECT unnest(range(50))::int AS point)"""
    )
    + ")",
)
def _normal(spark, sf_dir):
    return rounded(P.normal_reference(line(spark, sf_dir), NUMBERS))


@query(
    "x9_skewness_kurtosis",
    each(
        """SELECT '{c}' AS variable, round(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5), 4) AS skew,
      round(avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3, 4) AS kurtosis
      FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"""
    ),
)
def _moments(spark, sf_dir):
    return rounded(P.shape_stats(line(spark, sf_dir), NUMBERS))


@query(
    "x10_density",
    "WITH numbers AS (SELECT 'price' AS variable, l_extendedprice / 1000 AS value FROM lineitem), "
    + density_sql("numbers", "variable")
    + " SELECT variable, point, x, density FROM density",
)
def _density(spark, sf_dir):
    price = (F.col("l_extendedprice") / 1000).alias("price")
    counts = value_counts_long(table(spark, sf_dir, "lineitem").select(price), ["price"])
    return rounded(P.density(counts, ["variable"]))


@query(
    "x11_box_statistics",
    each(
        """SELECT '{c}' AS variable, round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
      min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::double AS whisker_low,
      max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::double AS whisker_high,
      count(*) FILTER ({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""
    ),
)
def _box(spark, sf_dir):
    return rounded(P.box_stats(line(spark, sf_dir), NUMBERS))


FREQUENT = ["state", "listing_type", "shipping_mode", "attribute_id"]


@query(
    "x12_category_shares",
    with_listing(
        each(
            """SELECT '{c}' AS variable, {c} AS value, count(*) AS n, round(count(*) / (SELECT count({c}) FROM listing), 10) AS share,
      count(*) / (SELECT count({c}) FROM listing) < 0.05 AS rare FROM listing WHERE {c} IS NOT NULL GROUP BY {c}""",
            FREQUENT,
        )
    ),
)
def _category_shares(spark, sf_dir):
    return rounded(C.category_shares(listing_rows(spark, sf_dir), FREQUENT), 10)


@query(
    "x13_category_by_target",
    with_listing(
        each(
            "SELECT '{c}' AS variable, {c} AS value, target, count(*) AS n FROM listing WHERE {c} IS NOT NULL GROUP BY {c}, target",
            FREQUENT,
        )
    ),
)
def _category_target(spark, sf_dir):
    return C.category_target_counts(listing_rows(spark, sf_dir), FREQUENT, "target")


@query(
    "x15_describe",
    each(
        """SELECT '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::double AS min,
      round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3,
      max({c})::double AS max FROM lineitem"""
    ),
)
def _describe(spark, sf_dir):
    return rounded(P.describe(line(spark, sf_dir), NUMBERS))
