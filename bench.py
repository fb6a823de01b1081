"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Every query runs once to the end of a no-op sink, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wareloom.plans.catalog import QUERIES
from wareloom.session import build_session

HEADLINES = [
    "a1_entity_product",
    "a1_entity_seller",
    "a1_entity_site",
    "a6_conditions_per_product",
    "a8_repeated_rows",
    "a10_stats_by_target",
    "a11_scalar_aggregates",
    "a14_weekday_hour_of_events",
    "b3_varying_values_per_product",
    "b5_condition_shares",
    "b6_amount_density",
    "b8_new_by_weekday_hour",
    "b9_top_revenue_titles",
    "w1_rows_with_repeated_line",
    "u1_distinct_rows",
    "s1_json_lines",
    "n10_flat_rows",
    "p2_preprocess_product",
    "x3_correlation_matrix",
    "x5_cramers_v_matrix",
    "x6_histogram",
    "x7_empirical_cdf",
    "x11_box_statistics",
    "x12_category_shares",
    "x15_describe",
    "l1_stratified_split",
    "e1_random_sample_imputation",
    "e4_encoded_columns",
    "m3_roc_auc",
    "m7_threshold_sweep",
    "m1_trained_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            # The bench tables are single small files: split them for all cores.
            "spark.sql.files.maxPartitionBytes": "2m",
            "spark.sql.files.openCostInBytes": "64k",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["k7_null_predicates"](spark, sf_dir).collect()
    times = {}
    for name in only or HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
