import math
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from wareloom.operators.association import corr_matrix, corr_pairs, cramers_v, cramers_v_matrix
from wareloom.operators.profile import box_stats, density, describe, histogram, normal_reference
from wareloom.operators import ranks
from wareloom.operators.ranks import empirical_cdf, exact_quantiles, order_statistics, running_totals, value_counts_long


def test_running_totals_against_brute_force(spark):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.8 else "b", i, rng.randint(0, 9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, n int").repartition(8)
    got = {(r.g, r.o): r.cum for r in running_totals(df, ["g"], ["o"], {"cum": "n"}).collect()}
    sums = {"a": 0, "b": 0}
    for g, o, n in rows:
        sums[g] += n
        assert got[(g, o)] == sums[g]
    whole = running_totals(df.select("o", "n"), [], [F.col("o").desc()], {"cum": "n"}).collect()
    assert max(r.cum for r in whole) == sum(n for _, _, n in rows)


def test_quantiles_match_numpy_on_skewed_values(spark):
    rng = random.Random(5)
    x = [0.0] * 1000 + [rng.lognormvariate(0, 2) for _ in range(1500)]
    y = [float(rng.randint(0, 3)) for _ in x]
    df = spark.createDataFrame(list(zip(x, y)) + [(None, 1.0)], "x double, y double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = {r.variable: r for r in exact_quantiles(df, ["x", "y"], shares).collect()}
    for i, q in enumerate(shares):
        assert found["x"][f"q_{i}"] == pytest.approx(np.quantile(x, q))
        assert found["y"][f"q_{i}"] == pytest.approx(np.quantile([*y, 1.0], q))


def test_order_statistics_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    x = [nan, inf, -inf, 1e308, -1e308, 0.0, 5e-324, 1.0, 1.0 + 2**-52, None, -0.0, inf]
    df = spark.createDataFrame([(v, i, None) for i, v in enumerate(x)], "x double, i int, nothing double").repartition(3)
    order = sorted([v for v in x if v is not None and v == v]) + [nan]
    found = order_statistics(df, {"x": set(range(len(order))), "i": {0, 5, 11}})
    assert [str(found["x", k] + 0.0) for k in range(len(order))] == [str(v + 0.0) for v in order]
    assert [found["i", k] for k in (0, 5, 11)] == [0.0, 5.0, 11.0]
    assert [r.variable for r in exact_quantiles(df, ["i", "nothing"], [0.5]).collect()] == ["i"]


def test_cdf_ends_at_one(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 1.0, 2.0, 4.0]], "x double")
    rows = sorted((r.value, r.share) for r in empirical_cdf(df, ["x"]).collect())
    assert rows == [(1.0, 0.5), (2.0, 0.75), (4.0, 1.0)]


def test_histogram_last_bin_is_closed_and_constant_column_has_a_range(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(101)], "x double, c double")
    rows = histogram(df, ["x", "c"], bins=10).collect()
    x = {r.bin: r.n for r in rows if r.variable == "x"}
    assert x[9] == 11 and sum(x.values()) == 101 and len(x) == 10
    c = {r.bin: r.n for r in rows if r.variable == "c"}
    assert c[5] == 101 and sum(c.values()) == 101


def test_density_matches_direct_sum(spark):
    rng = random.Random(1)
    x = [rng.gauss(0, 1) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    rows = density(value_counts_long(df, ["x"]), ["variable"], points=20).collect()
    width = np.std(x, ddof=1) * len(x) ** -0.2
    for r in rows:
        direct = np.mean(np.exp(-0.5 * ((r.x - np.array(x)) / width) ** 2)) / (width * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(direct, rel=1e-3, abs=1e-4)


def test_box_and_describe(spark):
    values = [float(v) for v in range(1, 12)] + [100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    box = box_stats(df, ["x"]).first()
    assert (box.n_outliers, box.whisker_low, box.whisker_high) == (1, 1.0, 11.0)
    row = describe(df, ["x"]).first()
    assert (row.n, row.min, row.max, row.median) == (12, 1.0, 100.0, np.median(values))


def test_normal_reference_uses_the_error_function(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    rows = sorted(normal_reference(df, ["x"], points=11).collect(), key=lambda r: r.point)
    assert rows[5].cdf == pytest.approx(0.5) and rows[0].cdf < 0.1


def test_correlation_is_pairwise_and_safe_for_constants(spark):
    rows = [(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 1.0, 1.0), (4.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r.x, r.y): r["corr"] for r in corr_pairs(df, ["a", "b", "c"]).collect()}
    assert found[("a", "b")] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 7])[0, 1])
    assert found[("a", "c")] is None
    assert corr_matrix(df, ["a", "b", "c"]).count() == 9


def brute_cramers(pairs):
    xs, ys = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs})
    table = np.array([[sum(1 for p in pairs if p == (x, y)) for y in ys] for x in xs], dtype=float)
    n = table.sum()
    expected = table.sum(1, keepdims=True) @ table.sum(0, keepdims=True) / n
    r, k = table.shape
    gap = np.abs(table - expected)
    if r == 2 and k == 2:
        gap = gap - np.minimum(0.5, gap)
    chi2 = (gap**2 / expected).sum()
    phi2 = max(0, chi2 / n - (k - 1) * (r - 1) / (n - 1))
    denom = min(k - (k - 1) ** 2 / (n - 1) - 1, r - (r - 1) ** 2 / (n - 1) - 1)
    return 0.0 if denom == 0 else math.sqrt(phi2 / denom)


@pytest.mark.parametrize("shape", [(2, 2), (1, 3), (3, 4), (2, 5)])
def test_cramers_v_against_full_table(spark, shape):
    rng = random.Random(7)
    pairs = []
    for _ in range(200):
        x = rng.randrange(shape[0])
        y = (x + (rng.random() < 0.4) * rng.randrange(shape[1])) % shape[1]
        if (x, y) != (0, shape[1] - 1):  # leaves a zero cell
            pairs.append((f"x{x}", f"y{y}"))
    df = spark.createDataFrame([*pairs, ("x0", None)], "a string, b string")
    assert cramers_v(df, ["a", "b"]).first().v == pytest.approx(brute_cramers(pairs), abs=1e-9)


def test_cramers_matrix_is_square(spark):
    df = spark.createDataFrame([("a", "x", "1"), ("b", "y", "2"), ("a", "y", "1")], "p string, q string, r string")
    rows = cramers_v_matrix(df, ["p", "q", "r"]).collect()
    assert len(rows) == 9 and all(r.v == 1.0 for r in rows if r.x == r.y)


def skewed(spark):
    return spark.range(60_000).select(F.exp(F.col("id") / 1500).alias("x"), (F.col("id") % 7).cast("double").alias("y"))


def test_a_sketch_gives_the_first_range(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(ranks, "_bins_of", lambda *a, real=ranks._bins_of: passes.append(1) or real(*a))
    df = skewed(spark)
    x = np.exp(np.arange(60_000) / 1500)
    found = {r.variable: r for r in exact_quantiles(df, ["x", "y"], [0.01, 0.5, 0.9]).collect()}
    assert [found["x"][f"q_{i}"] for i in range(3)] == pytest.approx(np.quantile(x, [0.01, 0.5, 0.9]))
    with_sketch = len(passes)
    order_statistics(df, {"x": {599, 600, 29_999, 30_000}})
    assert with_sketch < len(passes) - with_sketch


def test_a_sketch_that_misses_changes_no_result(spark, monkeypatch):
    def wrong(df, columns, shares, real=ranks._starts):
        return {c: Row(**{**s.asDict(), "sketched": [1e6, 1e6 + 1] * len(shares)}) for c, s in real(df, columns, shares).items()}

    monkeypatch.setattr(ranks, "_starts", wrong)
    found = exact_quantiles(skewed(spark), ["x"], [0.25, 0.75]).first()
    assert [found.q_0, found.q_1] == pytest.approx(np.quantile(np.exp(np.arange(60_000) / 1500), [0.25, 0.75]))
