"""Shape of the plans, with Spark's own broadcasts switched off."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
ONE_SCAN = (
    "variant_summary", "variant_diff", "layout_variants", "namespace_inventory", "codegen_inventory", "package_variants",
)
MATCHING = (
    "masked_alias_join", "masked_prefix_join", "contains_join", "resolve_queries",
    "ranked_search_fuzzy", "lookup_parts", "part_variants", "portfolio_latest", "discover_variants",
    "pending_requests", "details_with_fetched",
)


def plan_of(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", MATCHING)
def test_joins_are_equi_joins(spark, name):
    plan = plan_of(spark, name)
    assert "SortMergeJoin" in plan
    assert not any(j in plan for j in ("NestedLoop", "CartesianProduct", "BroadcastExchange"))


@pytest.mark.parametrize("name", [
    "masked_alias_join", "masked_prefix_join", "contains_join", "resolve_queries", "canonicalize",
    "select_parts", "unresolved_inputs", "ranked_search",
])
def test_names_cut_into_pieces_are_not_broadcast(spark, name):
    # With Spark's own limit, by which the files behind these rows look small.
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("name", ONE_SCAN)
def test_profiles_scan_once(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Scan parquet") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["summary_totals", "tree_census", "assemble_details"])
def test_totals_and_keys_need_no_join(spark, name):
    plan = plan_of(spark, name)
    assert plan.count("Scan parquet") == 2 and "Join" not in plan


def test_diff_is_a_hash_aggregate(spark):
    assert "SortAggregate" not in plan_of(spark, "variant_diff")


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = plan_of(spark, "ranked_search")
    assert "WindowGroupLimit" in plan and "Partial" in plan.split("WindowGroupLimit")[-1].split("\n")[0]


def test_profiles_read_few_columns(spark):
    plan = plan_of(spark, "variant_summary")
    scanned = plan.split("ReadSchema: ")[-1] if "ReadSchema" in plan else plan.split("Scan parquet")[1]
    assert "text" not in scanned.split("\n")[0]
