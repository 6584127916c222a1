"""Physical plans: one scan per table, pruned columns, pushed filters."""

import os
import re

import pytest

import __spark_entry__
from sitelens.bindings import checks as ck

FOLDER = "/root/testdata/sf0.001"
QUERIES = __spark_entry__.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, column):
    return [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if column in s]


@pytest.mark.parametrize("name", ["ck_uc", "ck_ucy", "ck_ucg", "ck_mf", "ck_fot", "ck_dp"])
def test_all_checks_of_a_table_share_one_scan(spark, name):
    assert len(scans(plan_of(QUERIES[name](spark, FOLDER)), "l_orderkey")) == 1


def final_plan(df):
    """The plan that ran: initial plans, also those inside subqueries, are left out."""
    kept, skipped = [], None
    for line in plan_of(df).split("\n"):
        depth = re.search(r"[^ :|]|$", line).start()
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


# Scans of the facts once a query has run: what shares a shuffle is read once.
FACT_SCANS = [
    "ck_vc", "ck_vs", "ck_bmc", "ck_dcon", "ck_dcon_visit", "ck_ecp", "ck_fot", "ck_fotd", "pp_zero",
    "gt_03", "dm_03", "dm_04", "dm_05", "dm_06", "dm_06_groups", "rs_02", "ag_04", "co_15", "co_18",
]


@pytest.mark.parametrize("name", FACT_SCANS)
def test_a_shuffle_is_shared_when_the_query_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    assert len(scans(final_plan(df), "l_")) == 1


def test_final_plans_are_read_whole(spark):
    """A query over two scans has two, so that a count of one means something."""
    df = QUERIES["jn_08"](spark, FOLDER)
    df.collect()
    assert len(re.findall("FileScan parquet", final_plan(df))) >= 2


@pytest.mark.parametrize("name", ["ck_fot", "ck_fotd"])
def test_distinct_counts_do_not_repeat_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    assert "Expand" not in final_plan(df)


@pytest.mark.parametrize("name", ["co_15", "co_18"])
def test_visits_are_read_once_for_all_labels(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    assert len(scans(final_plan(df), "o_")) == 1


def test_texts_are_matched_once(spark):
    plan = plan_of(QUERIES["fl_08"](spark, FOLDER))
    assert len(scans(plan, "text")) == 1 and "RLIKE" not in plan.replace("RLIKE", "", 1)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(ck.uc(spark, FOLDER))
    (columns,) = scans(plan, "l_orderkey")
    assert "l_extendedprice" not in columns and "l_tax" not in columns


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["fl_01"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_returnflag,R\)", plan)


def test_shared_predicates_reach_the_scan(spark):
    plan = plan_of(QUERIES["fl_10"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*Or\(", plan)


def test_code_sets_are_joined_without_moving_the_facts(spark):
    plan = plan_of(QUERIES["jn_02"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
