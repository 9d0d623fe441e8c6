"""Registered queries against their SQL on the smallest tables, and the plans they get.

All queries run with ``LANEWISE_ALL=1``; without it, one or two of each kind.
"""

import os
import re

import pytest

import __spark_entry__ as entry
from lanewise.catalog.oracles import all_oracles
from lanewise.catalog.queries import all_queries
from lanewise.catalog.tables import delivery_lines
from lanewise.operators import features, metrics, ordering, stats
from tests.oracle import compare, connect

FOLDER = os.environ.get("LANEWISE_TABLES", "/root/testdata/sf0.001")
USUAL = [
    "read_cleaned", "decision_log", "iqr_fences", "winsorize", "avg_rank", "delay_by_group",
    "cycle_segments", "freight_share_by_mode", "scorecard", "watch_list", "abc_lookup",
    "country_mode_heatmap", "vendor_product_cross", "kruskal_wallis", "dunn_gated", "bh_fdr",
    "ols_drivers", "spearman", "histogram", "box_stats_unit_freight", "log_density",
    "otd_by_country", "supplier_summary",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()) if os.environ.get("LANEWISE_ALL") else USUAL)
def test_query_equals_sql(spark, connection, name):
    problem = compare(connection, name, all_queries()[name](spark, FOLDER))
    assert problem is None or problem.startswith("~")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(all_queries()) == set(all_oracles())
    assert set(all_oracles()) <= set(entry.oracle_sql()) <= set(entry.queries())


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_tables_are_read(spark):
    rows = delivery_lines(spark, FOLDER, ["mode", "delay_days"])
    text = plan(metrics.otd_by(rows, "mode"))
    assert "part.parquet" not in text and "supplier.parquet" not in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert any("l_shipdate" in s and "l_extendedprice" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    rows = delivery_lines(spark, FOLDER, ["insurance", "delivered_date"])
    text = plan(rows.where("delivered_date is not null").select("insurance"))
    assert "PushedFilters" in text


def test_segments_take_one_scan(spark):
    rows = delivery_lines(spark, FOLDER, ["c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total"])
    text = plan(metrics.cycle_segments(rows)).split("+- == Initial Plan ==")[0]
    assert text.count("lineitem.parquet") == 1


def single_task_inputs(df):
    """Row counts flowing into exchanges to a single task."""
    text = plan(df).split("+- == Initial Plan ==")[0]
    return text, re.findall(r"Exchange SinglePartition", text)


def test_ranks_sort_no_rows_in_one_task(spark):
    rows = delivery_lines(spark, FOLDER, ["insurance"])
    df = ordering.value_ranks(rows, "insurance")
    text, singles = single_task_inputs(df)
    # The only single task adds up the bucket totals.
    assert len(singles) <= 1
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_rank_tests_shuffle_counts_not_rows(spark):
    rows = delivery_lines(spark, FOLDER, ["mode", "delay_days"])
    sums = stats.rank_sums(rows, "mode")
    text = plan(stats.dunn_pairs(sums))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "parquet" not in text  # the pairs start from the group sums


def test_rare_categories_are_pooled_without_moving_rows(spark):
    rows = delivery_lines(spark, FOLDER, ["terms", "id"])
    text = plan(features.collapse_rare(rows, "terms", 1000))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
