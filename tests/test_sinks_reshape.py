"""Sinks (SNK1-SNK5) and reshape operators (RSH1-RSH3, ORD2, SRC8 fallback)."""

from __future__ import annotations

import pytest
from helpers import rows

from cohortlab.functions.sql import project
from cohortlab.operators import reshape as RS
from cohortlab.plans import reports
from cohortlab.sinks import tables as SNK
from cohortlab.sources import catalog as CAT


def test_range_bucket_matches_generate_array_buckets(spark):
    df = spark.createDataFrame([(y,) for y in (2001, 2003, 2004, 2005, 2017, 2018, 2019, 2025)] + [(None,)], "y bigint")
    got = [r[0] for r in df.selectExpr(SNK.range_bucket("y")).collect()]
    assert got == [0, 1, 1, 2, 8, 8, 9, 9, None]


def test_overwrite_is_rerun_safe_and_partitions_prune(spark, tmp_path):
    df = spark.createDataFrame([(2003, "50_65", "LOW", 1), (2005, "66_PLUS", "HIGH", 2), (2005, "50_65", "LOW", 3)],
                               "y bigint, band string, grp string, v bigint")
    df = project(df, ["*", f"{SNK.range_bucket('y')} AS bucket"])
    path = str(tmp_path / "t")
    SNK.write_table(df, path, partition_cols=["bucket"], cluster_cols=["band", "grp"])
    SNK.write_table(df, path, partition_cols=["bucket"], cluster_cols=["band", "grp"])
    back = spark.read.parquet(path)
    assert back.count() == 3
    pruned = back.filter("bucket = 2")
    assert "PartitionFilters: [isnotnull(bucket" in pruned._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in pruned.collect()) == [2, 3]


def test_dynamic_partition_overwrite_touches_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    a = spark.createDataFrame([(2003, 1), (2005, 2)], "c bigint, v bigint")
    SNK.write_partitions(a, path, ["c"])
    SNK.write_partitions(spark.createDataFrame([(2005, 9)], "c bigint, v bigint"), path, ["c"])
    assert sorted((r.c, r.v) for r in spark.read.parquet(path).collect()) == [(2003, 1), (2005, 9)]


def test_column_comments_reach_the_catalog(spark):
    df = spark.createDataFrame([(1, "a")], "k bigint, s string")
    SNK.save_table(spark, SNK.with_comments(df, {"k": "respondent key"}), "t_comments", comment="it's a test")
    cols = {c.name: c.description for c in spark.catalog.listColumns("t_comments")}
    assert cols["k"] == "respondent key"


def test_pivot_forms_agree(spark):
    df = spark.createDataFrame([("r1", 1, 2.0), ("r1", 1, 3.0), ("r1", 2, 4.0), ("r2", 2, 1.0)],
                               "k string, day int, g double")
    wide = RS.pivot_wide(df, ["k"], "day", [1, 2],
                         {"g": lambda on: f"sum(CASE WHEN {on} THEN g END)",
                          "n": lambda on: f"nullif(count(CASE WHEN {on} THEN 1 END), 0)"},
                         lambda v, stem: f"day_{v}_{stem}")
    builtin = RS.pivot_builtin(df, ["k"], "day", [1, 2], {"g": "sum(g)", "n": "count(1)"},
                               lambda v, stem: f"day_{v}_{stem}")
    cols = ["k", "day_1_g", "day_1_n", "day_2_g", "day_2_n"]
    assert rows(wide.select(cols), ["k"]) == rows(builtin.select(cols), ["k"])
    assert rows(wide.select(cols), ["k"])[1] == {"k": "r2", "day_1_g": None, "day_1_n": None, "day_2_g": 1.0,
                                                   "day_2_n": 1}


def test_melt_keeps_nulls_and_order_by_category(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "id string, x double, y double")
    got = rows(RS.melt(df, ["id"], None, "name", "value"), ["name"])
    assert got == [{"id": "a", "name": "x", "value": 1.0}, {"id": "a", "name": "y", "value": None}]
    cats = spark.createDataFrame([("HIGH",), ("LOW",), ("MODERATE",)], "g string")
    ordered = [r.g for r in RS.order_by_category(cats, "g", ["LOW", "MODERATE", "HIGH"], "o").collect()]
    assert ordered == ["LOW", "MODERATE", "HIGH"]


def test_an_empty_cohort_has_no_rates(spark, sf_dir):
    from cohortlab.plans.queries import dag

    cohort = dag(spark, sf_dir)["validation_cohort"]
    assert reports.mortality_rates_long(cohort.filter("1 = 0")).count() == 0
    assert reports.source_rates_long(cohort.filter("1 = 0")).count() == 0
    assert reports.mortality_rates_long(cohort).count() == 24


def test_missing_release_raises(spark):
    listing = spark.createDataFrame([("SURVEY_2003_2004_MORT_2015_PUBLIC.dat SURVEY_2003_2004_MORT_2019_PUBLIC.dat",)], "t string")
    cycles = spark.createDataFrame([(2003, 2004)], "cycle_start_year long, cycle_end_year long")
    assert [tuple(r) for r in CAT.latest_release_years(listing, "t", cycles=cycles).collect()] == [(2003, 2004, 2019)]
    more = spark.createDataFrame([(2003, 2004), (2005, 2006)], "cycle_start_year long, cycle_end_year long")
    with pytest.raises(Exception, match="no public mortality release found for cycle 2005"):
        CAT.latest_release_years(listing, "t", cycles=more).collect()


def test_full_refresh_drops_withdrawn_partitions(spark, tmp_path):
    path = str(tmp_path / "r")
    SNK.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "y long, v string"), path, ["y"])
    SNK.write_table(spark.createDataFrame([(1, "c")], "y long, v string"), path, ["y"])
    assert [(r.y, r.v) for r in spark.read.parquet(path).collect()] == [(1, "c")]


def test_few_cluster_keys_still_fill_the_partitions(spark):
    df = spark.range(200_000).selectExpr("id", "id % 4 AS band", "id % 6 AS grp")
    filled = SNK.clustered(df, ["band"], ["grp"], 400).selectExpr("spark_partition_id() AS p").distinct().count()
    assert filled > 300
    ordered = RS.order_by_category(
        df.selectExpr("id", "CASE band WHEN 0 THEN 'LOW' WHEN 1 THEN 'MODERATE' ELSE 'HIGH' END AS g"),
        "g", ["LOW", "MODERATE", "HIGH"], "o", ["id"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert ordered.selectExpr("spark_partition_id() AS p").distinct().count() > 30
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
