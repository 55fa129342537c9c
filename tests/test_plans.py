"""Plan properties the models rely on at scale (checked on the physical plan)."""

from __future__ import annotations

import pytest

from cohortlab.plans import reports
from cohortlab.plans.queries import _flow_cohort, dag

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return dag(spark, sf_dir)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_models_stay_in_the_jvm(models):
    for name, df in models.items():
        plan = physical(df)
        assert not any(n in plan for n in PYTHON_NODES), name


def test_source_estimates_is_one_hash_aggregate(models):
    plan = physical(models["protein_source_estimates"])
    assert "SortAggregate" not in plan
    assert plan.count("HashAggregate") == 2  # partial (map side) + final
    assert plan.count("Exchange hashpartitioning") == 1


def test_group_map_is_broadcast(models):
    plan = physical(models["protein_items"])
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "SortMergeJoin" not in plan


def test_null_rejecting_filters_make_joins_inner(models):
    plan = optimized(models["validation_cohort"])
    assert "Join Inner" in plan  # mortality eligibility and day-1 totals
    assert "Join LeftOuter" in plan  # glucose, day 2 and protein sources stay outer


def test_flow_cohort_prunes_cycles_and_pushes_age(spark, sf_dir):
    plan = physical(_flow_cohort(spark, sf_dir))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "RIDAGEYR" in line][0]
    assert "PartitionFilters: [isnotnull(CYCLE_START_YEAR" in scan and ">= 2003" in scan
    assert "GreaterThanOrEqual(RIDAGEYR,50.0)" in scan


def test_flow_cohort_sends_no_survey_table_through_the_driver(spark, sf_dir):
    """Tables of any file size meet by exchange, the demo side once."""
    cohort = _flow_cohort(spark, sf_dir).select("*")
    assert cohort.collect()
    plan = physical(cohort).split("== Initial Plan ==")[0]  # as it ran
    assert "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 4
    assert plan.count("Exchange hashpartitioning") == 5


def test_source_rates_scan_the_cohort_once(models):
    plan = optimized(reports.source_rates_wide(models["validation_cohort"]))
    assert plan.count("Generate inline") == 1
    assert plan.count("Aggregate [age_band_levine") == 1


def test_item_base_aggregate_reuses_the_join_partitioning(spark, sf_dir):
    from cohortlab.sources import landing as L

    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the large-table case
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = L.item_base(L.read_driver(spark, sf_dir, "orders"), L.read_driver(spark, sf_dir, "lineitem"))
        plan = physical(base)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2  # one per join input, none after the join
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "l_orderkey" in line][0]
    assert "l_shipdate" not in scan and "l_comment" not in scan


def _without_broadcast(spark, build):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        return physical(build())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_item_sums_are_exchanged_once_into_the_marts(spark, models):
    """M4: five joined inputs and the items; M5 and M6 add their own grouping."""
    for name, most in (("validation_cohort", 6), ("validation_summary", 7), ("cycle_protein_trends", 7)):
        plan = _without_broadcast(spark, lambda n=name: models[n].select("*"))
        assert plan.count("Exchange hashpartitioning") <= most, (name, plan.count("Exchange hashpartitioning"))
        assert "SortAggregate" not in plan


def test_mortality_rates_plan_the_cohort_once(models):
    plan = physical(reports.mortality_rates_long(models["validation_cohort"]))
    assert plan.count("FileScan parquet") <= 7 and "Limit" not in plan


def test_a_query_lands_only_the_tables_it_reads(spark, tmp_path):
    import os

    from cohortlab.sources.landing import Landed

    landed = Landed(spark, "/root/testdata/sf0.001", str(tmp_path / "landing"))
    assert landed["demo"].count() > 0
    assert os.listdir(tmp_path / "landing") == ["demo"]
    landed["dr2tot"].count()
    assert sorted(os.listdir(tmp_path / "landing")) == ["_item_base", "demo", "dr2iff", "dr2tot"]
