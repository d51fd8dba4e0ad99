"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the scale directory and BENCH_CPUS the local cores.  Every
result is written to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "flagship_which_place_moved_most",
    "a1_sum_by_place_and_period",
    "a2_count_by_kind",
    "a7_multi_holder_share",
    "a15_upper_median",
    "a20_vintage_fingerprint",
    "f9_validate_batch",
    "f15_drop_incomplete_tail",
    "j5_l5_asof_denominator",
    "j6_merge_with_revisions",
    "j8_as_of_many_dates",
    "j9_snapshot_diff",
    "j12_pooled_neighbours",
    "w1_expanding_zscore",
    "w3_robust_outlier",
    "w4_year_over_year",
    "w10_events_to_months",
    "n1_n2_normalised_names",
    "s5_delimited",
    "s10_a2_navigation_log",
    "s12_paragraph_events",
    "a17_index_history",
    "w9_q4_regime_timeline",
    "a18_o4_signature_match",
    "l1_l2_l3_lead_lag",
    "m1_m2_m3_baselines",
    "m5_m6_walk_forward",
    "m7_m8_issued_forecasts",
    "m10_m11_transition_probability",
    "q1_metric_cards",
    "q7_a14_desk_entries",
    "x1_closed_buckets",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = local_session("bench", cpus)
    # Starting the JVM and the first scan are not part of any query.
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
