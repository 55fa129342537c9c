"""Star joins under skew: rows without a key and hot keys are dealt over many tasks."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from cohortlab.operators.joins import SPREAD, hot_keys, left_star_join, spread_star_join


@pytest.fixture
def skewed(spark):
    """A third of the rows has no key, a third one key, the others one each."""
    fact = spark.range(60_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE id END AS k", "id AS v", "id % 5 AS w")
    dims = [spark.range(0, 60_000, step).selectExpr("id AS k", f"id * {step} AS d{step}") for step in (1, 2, 7)]
    return fact, dims


def test_results_equal_the_plain_chain(skewed):
    fact, dims = skewed
    hot = hot_keys(fact, "k", 100)
    assert [tuple(r) for r in hot.collect()] == [(7, 20_000)]
    want = sorted(map(str, left_star_join(fact, dims, "k").collect()))
    for chosen in (None, hot):
        got = spread_star_join(fact, dims, "k", chosen, parts=8)
        assert got.columns == left_star_join(fact, dims, "k").columns
        assert sorted(map(str, got.collect())) == want


def test_two_keys_duplicates_and_missing_matches(spark):
    fact = spark.createDataFrame([(1, "a", 1), (1, None, 2), (None, "a", 3), (1, "a", 1), (2, "b", 4), (9, "z", 5)], "x int, y string, v int")
    dim = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (2, "b", 12), (None, "a", 13), (1, None, 14)], "x int, y string, d int")
    hot = fact.where("x = 1 AND y = 'a'").select("x", "y")
    want = sorted(map(str, left_star_join(fact, [dim], ["x", "y"]).collect()))
    assert sorted(map(str, spread_star_join(fact, [dim], ["x", "y"], hot, parts=3).collect())) == want
    assert spread_star_join(fact.where("1 = 0"), [dim], ["x", "y"], hot).count() == 0


def test_no_partition_is_much_larger_than_the_others(spark, skewed):
    fact, dims = skewed
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(old, ("-1", "false", "16")):
        spark.conf.set(k, v)
    try:
        def rows(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]

        plain = rows(left_star_join(fact, dims, "k"))
        spread = spread_star_join(fact, dims, "k", hot_keys(fact, "k", 100))
        plan = spread.select("*")._jdf.queryExecution().executedPlan().toString()
        dealt = rows(spread)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(plain) > 10 * statistics.median(plain)
    assert len(dealt) == 16 and max(dealt) < 3 * statistics.median(dealt)
    # the fact side moves once, each dimension once
    assert plan.count(f"Exchange hashpartitioning(k") == 1 + len(dims) + 1, plan  # and the key counts of the hot keys
    assert SPREAD in plan


def test_more_hot_keys_than_allowed_is_an_error(spark, skewed):
    fact, dims = skewed
    many = spark.range(50).selectExpr("id AS k")
    with pytest.raises(Exception, match="more than 10 rows"):
        spread_star_join(fact, dims, "k", many, bound=10).collect()
