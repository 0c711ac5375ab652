"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8), BENCH_RUNS (1),
BENCH_QUERIES (comma-separated keys, or ``all``). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallyweave.session import get_session
from tallyweave.suite import QUERIES

HEADLINE = (
    "rfm_table agg_order_rollup agg_customer_summary agg_profile_by_key agg_sum_mean_size agg_describe "
    "agg_group_median_std agg_quantile agg_mode agg_term_doc_freq agg_string_concat agg_fill_profile agg_eta_squared "
    "agg_corr_matrix jn_left_chain jn_corr_scalar jn_scalar_first jn_nearest_geo jn_knn jn_grid_complete "
    "win_week_tumbling win_cumsum win_rank win_latest_nonnull win_last_order win_dedup_coalesce win_loo_median "
    "win_word_median win_cascade_impute upd_rule_domain prj_energy_recompute prj_composite_index fn_kv_wide fn_tokenise "
    "credit_matrix country_ranking ml_impute_iterative ml_tfidf ml_confusion_report ml_drift ml_business_cost st_weekly_totals"
).split()


def run(spark, key: str, sf_dir: str) -> float:
    start = time.time()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = get_session("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    run(spark, "agg_sum_mean_size", sf_dir)
    seconds = {}
    for key in keys:
        first = run(spark, key, sf_dir)  # warm-up of this query's plan and code
        seconds[key] = round(statistics.median([run(spark, key, sf_dir) for _ in range(runs)]) if runs else first, 3)
        print(f"{key:28s} {first:7.2f} {seconds[key]:7.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
