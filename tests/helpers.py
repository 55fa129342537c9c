"""Small helpers of the tests; not in a conftest, whose name every test folder shares."""

from __future__ import annotations


def rows(df, order=None):
    """Collect as a list of dicts (small test frames only)."""
    out = [r.asDict() for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out


def one_col(spark, exprs, data, schema):
    """Evaluate expression texts over a tiny literal frame."""
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.selectExpr(*exprs).collect()]
