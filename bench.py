"""Time the headline queries on whole tables; prints one JSON line.

BENCH_SF_DIR picks the data (default sf0.1), BENCH_CPUS the local threads. Each query runs
once to warm up; the faster of two further runs counts. Results go to the no-op sink, so
every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starling.plans.catalog import QUERIES  # noqa: E402
from starling.session import get_session  # noqa: E402

HEADLINE = [
    "W1_posts_today_limit_100",
    "W2_top_100_posters_past_week",
    "W3_term_post_count_past_week",
    "A1_posts_per_day_past_3_weeks",
    "W4_last_10_posts_by_author",
    "W5_last_10_liked_posts_by_author",
    "J12_check_new",
    "J9_anti_join_seen",
    "P8_route_records",
    "P9_parse_event_log",
    "D5_collapse_to_latest",
    "D6_drop_tombstones",
    "M2_mask_cross_file_duplicates",
    "F14_filter_records_bluesky",
    "D1_drop_already_preprocessed",
    "J1_consolidate",
    "flagship_curated_funnel",
    "A17_latency_stats",
    "A6_activity_counts",
    "C3_derive_stats",
    "T7_gini",
    "T8_mean_pairwise_cosine",
    "T10_group_metrics",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", partitions=cpus)
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for run in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            if run:
                best = min(best, spent)
        times[name] = round(best, 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
