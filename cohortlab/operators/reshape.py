"""Reshape, set and ordering operators (RSH1-RSH3, SET1, ORD2, DRV16-17).

Pivot and melt run on DataFrames, never on collected results: the wide side
is a conditional aggregate, the long side a generated unpivot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.bands import category_ordinal, lit
from cohortlab.functions.sql import _esc, aggregate, project, q


def union_all_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``UNION ALL`` matched by column name; with ``allow_missing`` absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def pivot_wide(df: DataFrame, keys: Sequence[str], pivot_col: str, pivot_values: Sequence,
               measures: dict[str, Callable[[str], str]], name: Callable[[object, str], str]) -> DataFrame:
    """Long to wide with explicit pivot values as one conditional aggregate.

    ``measures`` maps an output stem to a builder that receives the cell's
    filter text, e.g. ``{"protein_g": lambda on: f"max(CASE WHEN {on} THEN protein_g END)"}``.
    Explicit values mean no extra job to discover them, and every cell is
    computed in a single ``GROUP BY`` (one shuffle on ``keys``).
    """
    aggs = []
    for v in pivot_values:
        on = f"{q(pivot_col)} = {lit(v)}"
        for stem, build in measures.items():
            aggs.append(f"{build(on)} AS {q(name(v, stem))}")
    return aggregate(df, [q(k) for k in keys], aggs)


def pivot_builtin(df: DataFrame, keys: Sequence[str], pivot_col: str, pivot_values: Sequence,
                  aggs: dict[str, str], name: Callable[[object, str], str]) -> DataFrame:
    """The same reshape through ``GroupedData.pivot`` (explicit values) and a rename.

    ``aggs`` maps an alias to aggregate expression text. Spark names the
    pivoted columns ``<value>_<alias>``; they are renamed with ``name``.
    """
    wide = df.groupBy(*keys).pivot(pivot_col, list(pivot_values)).agg(
        *[F.expr(e).alias(a) for a, e in aggs.items()])
    if len(aggs) == 1:
        (alias,) = aggs
        renames = {str(v): name(v, alias) for v in pivot_values}
    else:
        renames = {f"{v}_{a}": name(v, a) for v in pivot_values for a in aggs}
    return wide.withColumnsRenamed(renames)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None, var_name: str,
         value_name: str) -> DataFrame:
    """Wide to long, NULL values kept. ``values=None`` melts every non-id column."""
    cols = list(values) if values is not None else [c for c in df.columns if c not in ids]
    items = ", ".join(q(c) for c in cols)
    head = _esc(f"SELECT {', '.join(q(i) for i in ids)}, {q(var_name)}, {q(value_name)} ")
    tail = _esc(f" UNPIVOT INCLUDE NULLS ({q(value_name)} FOR {q(var_name)} IN ({items}))")
    return df.sparkSession.sql(head + "FROM {t}" + tail, t=df)


def relabel(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Replace display values in one column (``50_65 -> 50-65``)."""
    case = "CASE " + " ".join(f"WHEN {q(column)} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) \
        + f" ELSE {q(column)} END"
    return project(df, [f"{case} AS {q(column)}" if c == column else q(c) for c in df.columns])


def title_label(c: str, drop_suffix: str = "_rate") -> str:
    """``cancer_rate -> Cancer``: drop suffix, underscores to spaces, title case."""
    return f"initcap(replace(replace({c}, {lit(drop_suffix)}, ''), '_', ' '))"


def order_by_category(df: DataFrame, column: str, categories: Sequence[str],
                      ordinal_name: str | None = None, then_by: Sequence[str] = ()) -> DataFrame:
    """Sort by an ordered category (LOW < MODERATE < HIGH).

    Row-level callers give a key in ``then_by``: the range sort then splits a
    category over many partitions instead of one each.

    With ``ordinal_name`` the ordinal is also kept as a column, so the order
    survives order-insensitive comparisons.
    """
    ordinal = category_ordinal(q(column), categories)
    if ordinal_name:
        return project(df, [*[q(c) for c in df.columns], f"{ordinal} AS {q(ordinal_name)}"]).orderBy(
            ordinal_name, *then_by)
    return df.orderBy(F.expr(ordinal), *then_by)
