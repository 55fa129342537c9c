"""Semantic rules R1-R26 on tiny literal frames."""

from __future__ import annotations

import math

import pytest
from helpers import one_col
from pyspark.sql import functions as F

from cohortlab.functions import bands as B
from cohortlab.functions import casts as C
from cohortlab.operators import aggregates as A


def test_r1_safe_int_rounds_half_away_from_zero(spark):
    got = one_col(spark, [C.safe_int("x")], [(2.5,), (-2.5,), (3.5,), (2.4,), (None,), (math.nan,),
                                             (math.inf,)], "x double")
    assert [g[0] for g in got] == [3, -3, 4, 2, None, None, None]


def test_r2_float_key_text_has_no_fraction(spark):
    got = one_col(spark, [C.float_text("x")], [(21005.0,), (1.5,), (None,)], "x double")
    assert [g[0] for g in got] == ["21005", "1.5", None]


def test_r3_composite_key_is_null_with_a_null_part(spark):
    got = one_col(spark, [C.respondent_key("s", "a", "b")], [(1.0, 2003, 2004), (None, 2003, 2004)],
                  "s double, a bigint, b bigint")
    assert [g[0] for g in got] == ["1|2003|2004", None]


def test_r4_safe_ratio_null_on_zero_or_null(spark):
    got = one_col(spark, [B.safe_ratio("n", "d")], [(1.0, 0.0), (1.0, None), (1.0, 4.0)], "n double, d double")
    assert [g[0] for g in got] == [None, None, 0.25]


def test_r5_zero_kcal_is_high_and_thresholds_are_strict(spark):
    share = B.protein_energy_share("g", "k")
    got = one_col(spark, [B.protein_group(share)],
                  [(10.0, 0.0), (2.5, 100.0), (5.0, 100.0), (4.9, 100.0), (None, 100.0)], "g double, k double")
    # 0 kcal -> NULL share -> HIGH; 0.10 exactly -> MODERATE; 0.20 exactly -> HIGH
    assert [g[0] for g in got] == ["HIGH", "MODERATE", "HIGH", "MODERATE", "HIGH"]


def test_r6_null_age_falls_to_else(spark):
    got = one_col(spark, [B.age_band_levine("a"), B.adult_age_band("a")], [(None,), (17,), (18,), (50,), (65,), (66,)],
                  "a bigint")
    assert got == [("UNDER_50", "UNDER_18"), ("UNDER_50", "UNDER_18"), ("UNDER_50", "18_49"),
                   ("50_65", "50_65"), ("50_65", "50_65"), ("66_PLUS", "66_PLUS")]


def test_r7_paper_band_leaves_gap_for_raw_float_age(spark):
    got = one_col(spark, [B.paper_age_band("a")], [(65.5,), (65.0,), (66.0,), (49.9,), (None,)], "a double")
    assert [g[0] for g in got] == [None, "50_65", "66_PLUS", None, None]
    # the integer path rounds first: 65.5 -> 66
    got = one_col(spark, [B.age_band_levine(C.safe_int("a"))], [(65.5,)], "a double")
    assert got == [("66_PLUS",)]


def test_r8_flag_is_three_valued(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "s bigint")
    flags = [r[0] for r in df.selectExpr(B.equals_flag("s", 1)).collect()]
    assert flags == [True, False, None]
    assert df.filter(B.equals_flag("s", 1)).count() == 1
    got = df.selectExpr(f"sum(CASE WHEN {B.equals_flag('s', 1)} THEN 10 ELSE 0 END)").first()[0]
    assert got == 10


def test_r9_glucose_category_order(spark):
    got = one_col(spark, [B.glucose_category("g")], [(99.9,), (100.0,), (125.9,), (126.0,), (None,)], "g double")
    assert [g[0] for g in got] == ["NORMAL_RANGE", "PREDIABETES_RANGE", "PREDIABETES_RANGE", "DIABETES_RANGE",
                                   "MISSING"]


def test_r10_weighted_sums_null_weight_variants(spark):
    df = spark.createDataFrame([(True, 10.0), (True, None), (False, 5.0)], "f boolean, w double")
    r = df.selectExpr(f"{A.weighted_total('w')} AS t", f"{A.weighted_conditional('f', 'w')} AS c",
                      f"{A.weighted_conditional('f', 'w', null_weight_as_zero=False)} AS c2").first()
    assert (r.t, r.c, r.c2) == (15.0, 10.0, 10.0)


def test_r11_weighted_rate_safe_on_zero_weight(spark):
    df = spark.createDataFrame([("a", True, 0.0), ("b", True, 2.0), ("b", False, 6.0)], "k string, f boolean, w double")
    got = dict((r[0], r[1]) for r in df.groupBy("k").agg(F.expr(A.weighted_rate("f", "w"))).collect())
    assert got == {"a": None, "b": 250.0}


def test_r12_dashboard_bins_are_fixed_cut_points(spark):
    got = one_col(spark, [B.animal_protein_bins("g"), B.plant_protein_bins("g")],
                  [(24.9,), (25.0,), (35.0,), (45.0,), (9.9,)], "g double")
    assert got == [("Q1 (Low)", "Q4 (High)"), ("Q2", "Q4 (High)"), ("Q3", "Q4 (High)"),
                   ("Q4 (High)", "Q4 (High)"), ("Q1 (Low)", "Q1 (Low)")]


def test_r13_cause_codes_stay_strings(spark):
    got = one_col(spark, [B.equals_flag("c", "002"), "c IN ('001', '005')"], [("002",), ("2",), ("005",), (None,)],
                  "c string")
    assert got == [(True, False), (False, False), (False, True), (None, None)]


def test_r14_r15_constants(spark):
    got = one_col(spark, [B.rescale_weight("w"), B.protein_energy_share("g", "k")], [(800.0, 25.0, 1000.0)],
                  "w double, g double, k double")
    assert got == [(100.0, 0.1)]


def test_r16_two_day_mean_needs_both_day_two_values(spark):
    expr = B.two_day_mean_share("p1", "k1", "p2", "k2")
    got = one_col(spark, [expr], [(10.0, 400.0, 30.0, 400.0), (10.0, 400.0, None, 400.0),
                                  (10.0, 400.0, 30.0, None), (0.0, 0.0, 0.0, 0.0)],
                  "p1 double, k1 double, p2 double, k2 double")
    assert [g[0] for g in got] == [0.2, None, None, None]


def test_r19_lpad_truncates_and_major_group(spark):
    padded = C.padded_code("c")
    got = one_col(spark, [padded, C.leading_digit(padded)], [(11234567,), (123456789,), (None,), (1234567,)],
                  "c bigint")
    assert got == [("11234567", 1), ("12345678", 1), (None, None), ("01234567", 0)]


def test_r20_r21_decimal_measures_use_double_ratios(spark):
    df = spark.createDataFrame([("1.5", "3")], "a string, b string").selectExpr(
        f"{C.safe_numeric('a')} AS a", f"{C.safe_numeric('b')} AS b")
    assert str(df.schema["a"].dataType) == "DecimalType(38,9)"
    assert df.selectExpr(f"{B.safe_ratio('a', 'b')} AS r").first().r == 0.5
    assert df.selectExpr(f"{A.mean('a')} AS m").first().m == 1.5


def test_r25_accepted_values_and_unique_ignore_nulls(spark):
    from cohortlab.operators import quality as Q

    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("z",)], "c string")
    assert Q.unique_failures(df, "c").count() == 1
    assert [r.c for r in Q.accepted_values_failures(df, "c", ["a"]).collect()] == ["z"]


def test_lookup_bound_is_enforced(spark):
    from cohortlab.operators.joins import lookup_join

    df, dim = spark.range(3).toDF("k"), spark.range(5).selectExpr("id AS k", "id * 2 AS v")
    assert sorted(r.v for r in lookup_join(df, dim, "k", dim_row_bound=5).collect()) == [0, 2, 4]
    with pytest.raises(Exception, match="more than 4 rows"):
        lookup_join(df, dim, "k", dim_row_bound=4).collect()


def test_checkpoint_folder_is_required_on_a_cluster():
    from cohortlab.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Cluster())
