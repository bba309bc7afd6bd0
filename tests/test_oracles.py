"""Registered queries beside their DuckDB text on the smallest data.

By default one query per area; ORACLES=all runs every one (tests/oracle.py does so too, at
sf0.01).
"""

import os

import pytest

from starling.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SOME = [
    "P8_route_records", "P9_parse_event_log", "P10_build_post_row", "F14_filter_records_bluesky",
    "D1_drop_already_preprocessed", "D5_collapse_to_latest", "J1_consolidate", "F17_apply_rules",
    "U6_create_labels", "A17_latency_stats", "W5_last_10_liked_posts_by_author", "W9_row_budget_tasks",
    "G2_comment_tree_order", "T7_gini", "C3_derive_stats", "M2_mask_cross_file_duplicates",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ORACLES") == "all" else SOME)
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok, text
