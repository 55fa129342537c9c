"""Data-quality operators (DQ1-DQ5).

Each check returns its failing rows as a DataFrame (the warehouse-test
convention) or, for the report, one row per check with the failing count.
Not-NULL and accepted-values checks on one table are batched into a single
aggregate pass; uniqueness needs one aggregate per key column, with
map-side partial counts, so a hot key collapses before the shuffle. Tables of a
warehouse bring the counts of their writes along; of them only keys are read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cohortlab.functions.bands import lit
from cohortlab.functions.sql import aggregate, project, q
from cohortlab.operators.reshape import union_all_by_name

REPORT_COLUMNS = ["check_name", "model_name", "column_name", "failing_rows", "passed"]


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.filter(f"{q(column)} IS NULL")


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` occurring more than once (NULLs ignored), with their counts."""
    return unique_key_failures(df, [column])


def unique_key_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Duplicated composite keys (a row with any NULL part is ignored), with counts."""
    where = " AND ".join(f"{q(c)} IS NOT NULL" for c in columns)
    return aggregate(df, [q(c) for c in columns], ["count(1) AS n_records"], where=where,
                     having="count(1) > 1")


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Non-NULL values outside the accepted list, with their counts."""
    c = q(column)
    return aggregate(df, [c], ["count(1) AS n_records"],
                     where=f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(lit(v) for v in values)})")


def reconcile_failures(left: DataFrame, right: DataFrame, key: str, left_col: str, right_col: str,
                       tolerance: str = "0.1") -> DataFrame:
    """Keys where two measures differ by more than ``tolerance`` (both present).

    Compared in decimal(38,9): a difference of exactly the tolerance passes.
    """
    exact = lambda x: f"cast({x} as decimal(38,9))"
    text = (f"SELECT l.{q(key)}, l.{q(left_col)}, r.{q(right_col)} FROM {{l}} l "
            f"LEFT JOIN {{r}} r ON l.{q(key)} = r.{q(key)} "
            f"WHERE l.{q(left_col)} IS NOT NULL AND r.{q(right_col)} IS NOT NULL "
            f"AND abs({exact('l.' + q(left_col))} - {exact('r.' + q(right_col))}) > {exact(lit(tolerance))}")
    return left.sparkSession.sql(text, l=left, r=right)


@dataclass
class TableChecks:
    """Generic column tests on one model."""

    model_name: str
    df: DataFrame
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


def table_report(tc: TableChecks) -> DataFrame:
    """One row per test on ``tc`` from a single grouped pass over the table.

    The table is grouped by its (first) unique key with map-side partial
    counts: the NULL-key group gives the key's not-NULL failures, groups with
    more than one row the uniqueness failures, and per-group counters the
    other columns' not-NULL failures. Accepted-values failures are the distinct
    bad values, as in the single check; each such column, like a second unique
    key, takes its own pass over that column.
    """
    if not tc.unique:
        return _flat_report(tc)
    u, rest = tc.unique[0], tc.unique[1:]
    counters = []  # (check, column, per-group counter expression or None for the key)
    for c in tc.not_null:
        counters.append(("not_null", c, None if c == u else f"count_if({q(c)} IS NULL)"))
    grouped = aggregate(tc.df, [f"{q(u)} AS k"], ["count(1) AS n", *[
        f"{expr} AS c{i}" for i, (_, _, expr) in enumerate(counters) if expr is not None]])
    totals = []
    for i, (chk, c, expr) in enumerate(counters):
        total = "sum(CASE WHEN k IS NULL THEN n ELSE 0 END)" if expr is None else f"sum(c{i})"
        totals.append((chk, c, total))
    totals.append(("unique", u, "count_if(k IS NOT NULL AND n > 1)"))
    structs = ", ".join(
        f"struct({lit(chk)} AS check_name, {lit(tc.model_name)} AS model_name, {lit(c)} AS column_name, "
        f"cast(coalesce({expr}, 0) as bigint) AS failing_rows)" for chk, c, expr in totals)
    parts = [project(aggregate(grouped, [], [f"array({structs}) AS checks"]), ["inline(checks)"])]
    for c in rest:
        dup = unique_failures(project(tc.df, [q(c)]), c)
        parts.append(aggregate(dup, [], [
            "'unique' AS check_name", f"{lit(tc.model_name)} AS model_name", f"{lit(c)} AS column_name",
            "count(1) AS failing_rows"]))
    return union_all_by_name(parts + _accepted_reports(tc))


def _accepted_reports(tc: TableChecks) -> list[DataFrame]:
    """Number of distinct bad values of each column with an accepted list."""
    return [aggregate(accepted_values_failures(project(tc.df, [q(c)]), c, vals), [], [
        "'accepted_values' AS check_name", f"{lit(tc.model_name)} AS model_name", f"{lit(c)} AS column_name",
        "count(1) AS failing_rows"]) for c, vals in tc.accepted.items()]


def _flat_report(tc: TableChecks) -> DataFrame:
    """Tests of a table without a unique key: one global pass for the not-NULL ones."""
    counts = [("not_null", c, f"count_if({q(c)} IS NULL)") for c in tc.not_null]
    if not counts:
        return union_all_by_name(_accepted_reports(tc))
    structs = ", ".join(
        f"struct({lit(chk)} AS check_name, {lit(tc.model_name)} AS model_name, {lit(c)} AS column_name, "
        f"cast({expr} as bigint) AS failing_rows)" for chk, c, expr in counts)
    flat = project(aggregate(tc.df, [], [f"array({structs}) AS checks"]), ["inline(checks)"])
    return union_all_by_name([flat, *_accepted_reports(tc)])


def singular_report(name: str, model: str, failures: DataFrame) -> DataFrame:
    """A singular test: its failing-row count."""
    return aggregate(failures, [], [f"{lit(name)} AS check_name", f"{lit(model)} AS model_name",
                                    "'' AS column_name", "count(1) AS failing_rows"])


@dataclass
class KeyTest:
    """A uniqueness test read from a table; ``stored``: bucketed by the column; ``nulls``: report NULLs too."""

    model_name: str
    df: DataFrame
    column: str
    stored: bool = False
    nulls: bool = True


def unique_report(tests: Sequence[KeyTest]) -> DataFrame:
    """All uniqueness tests, each table scanned once for its key column alone.

    Tables bucketed by the key are grouped where they lie; the keys of all others meet
    in one exchange, with map-side counts. What remains is a row per test.
    """
    number = {id(t): i for i, t in enumerate(tests)}
    stored = [aggregate(t.df, [f"{q(t.column)} AS k"], ["count(1) AS n"], where=f"{q(t.column)} IS NOT NULL") for t in tests if t.stored]
    stored = [project(df, [f"{number[id(t)]} AS test", "cast(k as string) AS k", "n"]) for df, t in zip(stored, [t for t in tests if t.stored])]
    # rows without a key bypass the grouping; one bucket would hold them all
    stored += [aggregate(t.df, [], [f"{number[id(t)]} AS test", "cast(null as string) AS k", "count(1) AS n"],
                         where=f"{q(t.column)} IS NULL") for t in tests if t.stored and t.nulls]
    loose = [project(t.df, [f"{number[id(t)]} AS test", f"cast({q(t.column)} as string) AS k"]) for t in tests if not t.stored]
    parts = stored + ([aggregate(union_all_by_name(loose), ["test", "k"], ["count(1) AS n"])] if loose else [])
    sums = aggregate(union_all_by_name(parts), ["test"], [
        "count_if(k IS NOT NULL AND n > 1) AS twice", "sum(CASE WHEN k IS NULL THEN n ELSE 0 END) AS nulls"])
    spark = sums.sparkSession
    rows = []
    for i, t in enumerate(tests):
        rows.append((i, "unique", t.model_name, t.column))
        if t.nulls:
            rows.append((i, "not_null", t.model_name, t.column))
    named = spark.createDataFrame(rows, "test int, check_name string, model_name string, column_name string")  # a row per test
    return spark.sql("SELECT /*+ BROADCAST(t) */ t.check_name, t.model_name, t.column_name, "
                     "cast(coalesce(CASE WHEN check_name = 'unique' THEN s.twice ELSE s.nulls END, 0) as bigint) AS failing_rows "
                     "FROM {t} t LEFT JOIN {s} s ON t.test = s.test", t=named, s=sums)


def counted_report(spark, counted: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    """Rows of tests that were counted while their tables were written."""
    return spark.createDataFrame(list(counted), "check_name string, model_name string, column_name string, failing_rows long")


def reconcile_report(left: DataFrame, right: DataFrame, key: str, comparisons: Sequence[tuple[str, str, str, str]],
                     tolerance: str = "0.1") -> DataFrame:
    """Several reconciliations of two tables from one join: (name, model, left column, right column) each."""
    exact = lambda x: f"cast({x} as decimal(38,9))"
    fails = [f"count_if(abs({exact('l.' + q(a))} - {exact('r.' + q(b))}) > {exact(lit(tolerance))})" for _, _, a, b in comparisons]
    structs = ", ".join(f"struct({lit(n)} AS check_name, {lit(m)} AS model_name, '' AS column_name, {f} AS failing_rows)"
                        for (n, m, _, _), f in zip(comparisons, fails))
    return left.sparkSession.sql(
        f"SELECT inline(checks) FROM (SELECT /*+ SHUFFLE_HASH(r) */ array({structs}) AS checks FROM {{l}} l "
        f"JOIN {{r}} r ON l.{q(key)} = r.{q(key)})", l=left, r=right)


def report_of(parts: Sequence[DataFrame]) -> DataFrame:
    return project(union_all_by_name(list(parts)), [*REPORT_COLUMNS[:-1], "failing_rows = 0 AS passed"])


def quality_report(tables: Sequence[TableChecks], singular: Sequence[tuple[str, str, DataFrame]] = ()) -> DataFrame:
    """All tests as rows ``(check_name, model_name, column_name, failing_rows, passed)``."""
    parts = [table_report(t) for t in tables]
    parts += [singular_report(n, m, f) for n, m, f in singular]
    return report_of(parts)
