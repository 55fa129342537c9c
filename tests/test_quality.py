"""Quality report against a brute-force count on a fixture with known failures."""

from __future__ import annotations

from cohortlab.operators.quality import TableChecks, quality_report, reconcile_failures


def test_report_counts_match_brute_force(spark):
    data = [("a", 1, "x"), ("a", None, "zz"), ("b", 2, "y"), (None, 3, "zz"), (None, 4, "x"), ("c", 5, None)]
    df = spark.createDataFrame(data, "k string, v bigint, g string")
    tc = TableChecks("t", df, not_null=["k", "v"], unique=["k"], accepted={"g": ["x", "y"]})
    got = {(r.check_name, r.column_name): (r.failing_rows, r.passed) for r in quality_report([tc]).collect()}
    py = {
        ("not_null", "k"): sum(1 for k, _, _ in data if k is None),
        ("not_null", "v"): sum(1 for _, v, _ in data if v is None),
        ("accepted_values", "g"): len({g for _, _, g in data if g is not None and g not in ("x", "y")}),
        ("unique", "k"): len({k for k, _, _ in data if k is not None and sum(1 for kk, _, _ in data if kk == k) > 1}),
    }
    assert got == {key: (n, n == 0) for key, n in py.items()}


def test_second_unique_key_and_tables_without_keys(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "a bigint, b bigint")
    rep = quality_report([TableChecks("t", df, unique=["a", "b"]), TableChecks("u", df, not_null=["a"])])
    got = {(r.model_name, r.check_name, r.column_name): r.failing_rows for r in rep.collect()}
    assert got == {("t", "unique", "a"): 1, ("t", "unique", "b"): 1, ("u", "not_null", "a"): 0}


def test_reconcile_tolerance_is_strict(spark):
    left = spark.createDataFrame([("r1", 5.3), ("r2", 10.0), ("r3", 10.0), ("r4", None)], "k string, a double")
    right = spark.createDataFrame([("r1", 5.4), ("r2", 10.11), ("r4", 1.0)], "k string, b double")
    got = [r.k for r in reconcile_failures(left, right, "k", "a", "b", "0.1").collect()]
    assert got == ["r2"]
