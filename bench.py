"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardflow.queries import QUERIES  # noqa: E402
from wardflow.session import local_session  # noqa: E402

HEADLINE = [
    "a_v1_program_history",
    "a_v2_daily_census",
    "a_v3_discharges",
    "a_v4_daily_kpi",
    "a_v5_discharge_counts",
    "a_v6_daily_census_report",
    "a_v7_census_trends_report",
    "a_a2_distinct_census",
    "a_j3_census_range_join",
    "a_i1_upsert_latest",
    "a_i5_upsert_generic",
    "a_j8_new_log_rows",
    "a_p1_normalised_patients",
    "b_j1_order_lines",
    "b_j6_asof_backward",
    "b_j9_interval_closed_left",
    "b_a23_median",
    "b_a23_quantile",
    "b_a18_histogram_fd",
    "b_r1_pivot_table_margins",
    "b_r6_wide_to_long",
    "b_w1_rolling_rows",
    "b_w2_rolling_time_right",
    "b_w9_expanding",
    "b_w10_ewm_mean",
    "b_w12_cumulative",
    "b_w14_rank_average",
    "b_m3_interpolate_time",
    "b_m7_drop_duplicates_first",
    "b_d14_resample_groups_empty",
    "b_o3_sample_by_group",
    "b_s7_text_profile_by_language",
    "b_q6_search_phrase",
    "b_t5_tumbling_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["a_v2_daily_census"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
