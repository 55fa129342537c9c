"""Join operators (JN1-JN6).

Every join in the models is an equi left outer join. Big-to-big joins are
left to sort-merge (or shuffled hash) joins, with adaptive execution free to
turn a side into a broadcast once its real size is known at runtime. A chain of joins on
one key keeps its partitioning, where the planner does not split skewed partitions:
:func:`spread_star_join` deals rows without a key, and rows of measured hot keys, over
many partitions first. An explicit broadcast hint is only placed on sides
whose row count is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortlab.functions.bands import lit
from cohortlab.functions.sql import q

# Row bound under which a side with a *proven* bound may be hinted for
# broadcast. Anything without a proven bound is left to AQE's runtime check.
BROADCAST_ROW_BOUND = 100_000


def left_star_join(fact: DataFrame, dims: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """``fact LEFT JOIN d1 USING (on) LEFT JOIN d2 USING (on) ...``.

    All joins share one key, so the fact side is exchanged once and every
    later join reuses its hash partitioning. Built as one statement.
    """
    keys = [on] if isinstance(on, str) else list(on)
    using = ", ".join(f"`{k}`" for k in keys)
    text = "SELECT * FROM {f}" + "".join(f" LEFT JOIN {{d{i}}} USING ({using})" for i in range(len(dims)))
    return fact.sparkSession.sql(text, f=fact, **{f"d{i}": d for i, d in enumerate(dims)})


# Parts that rows without a key are dealt into.
KEYLESS_PARTS = 1024
SPREAD = "_spread"


def hot_keys(fact: DataFrame, on: str | Sequence[str], most: int) -> DataFrame:
    """Keys of ``fact`` that hold more than one ``most``-th of its rows: fewer than ``most`` rows.

    Measured over all rows, with map-side partial counts.
    """
    keys = ", ".join(q(k) for k in ([on] if isinstance(on, str) else on))
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return fact.sparkSession.sql(
        f"SELECT {keys}, n FROM (SELECT {keys}, count(1) AS n FROM {{f}} GROUP BY {keys}) "
        f"WHERE {known} AND n * {most} > (SELECT count(1) FROM {{f}})", f=fact)


def spread_star_join(fact: DataFrame, dims: Sequence[DataFrame], on: str | Sequence[str], hot: DataFrame | None = None,
                     parts: int = 64, bound: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """:func:`left_star_join` that no key can slow down.

    A spread number is joined along with the key, once for the whole chain. It is 0 for
    most rows. Rows with a NULL key match nothing and get one of ``KEYLESS_PARTS`` numbers
    that no dimension has; rows with a key in ``hot`` (:func:`hot_keys`; at most ``bound``
    rows) get one of ``parts``, and a dimension's row with such a key is repeated for each. The
    number comes from the row's own hash, so a repeated task deals its rows alike.
    The fact side still moves once, and every later join reuses its partitioning.
    """
    keys = [on] if isinstance(on, str) else list(on)
    spark = fact.sparkSession
    same = lambda a, b: " AND ".join(f"{a}.{q(k)} = {b}.{q(k)}" for k in keys)
    listed = ", ".join(q(k) for k in keys)
    row = ", ".join(f"f.{q(c)}" for c in fact.columns)
    missing = " OR ".join(f"f.{q(k)} IS NULL" for k in keys)
    # of the dimensions' numbers only 0 .. parts - 1 exist
    away = f"{parts} + pmod(xxhash64({row}), {KEYLESS_PARTS})"
    if hot is None:
        left = spark.sql(f"SELECT f.*, CASE WHEN {missing} THEN {away} ELSE 0 END AS {SPREAD} FROM {{f}} f", f=fact)
        sides = [spark.sql(f"SELECT *, cast(0 as bigint) AS {SPREAD} FROM {{d}}", d=d) for d in dims]
    else:
        few = _bounded(spark.sql(f"SELECT DISTINCT {listed} FROM {{h}}", h=hot), bound)
        left = spark.sql(
            f"SELECT /*+ BROADCAST(h) */ f.*, CASE WHEN {missing} THEN {away} WHEN h.{q(keys[0])} IS NOT NULL "
            f"THEN pmod(xxhash64({row}), {parts}) ELSE 0 END AS {SPREAD} FROM {{f}} f LEFT JOIN {{h}} h ON {same('f', 'h')}",
            f=fact, h=few)
        sides = [spark.sql(
            f"SELECT /*+ BROADCAST(h) */ d.*, explode(CASE WHEN h.{q(keys[0])} IS NOT NULL THEN sequence(0L, {parts - 1}L) "
            f"ELSE array(0L) END) AS {SPREAD} FROM {{d}} d LEFT JOIN {{h}} h ON {same('d', 'h')}", d=d, h=few) for d in dims]
    using = f"{listed}, {SPREAD}"
    text = f"SELECT * EXCEPT ({SPREAD}) FROM {{f}}" + "".join(f" LEFT JOIN {{d{i}}} USING ({using})" for i in range(len(dims)))
    return spark.sql(text, f=left, **{f"d{i}": d for i, d in enumerate(sides)})


def lookup_join(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                defaults: dict[str, object] | None = None,
                dim_row_bound: int | None = None) -> DataFrame:
    """Left join to a dimension and fill unmatched attributes with defaults.

    ``dim_row_bound`` states that ``dim`` has at most so many rows; the side is
    then hinted for broadcast, and the bound is enforced: a further row is an
    error, not a large broadcast. Without it the join is planned by size
    statistics and AQE.
    """
    keys = [on] if isinstance(on, str) else list(on)
    hint = "/*+ BROADCAST(m) */ " if dim_row_bound is not None and dim_row_bound <= BROADCAST_ROW_BOUND else ""
    filled = set(defaults or {})
    left_cols = [f"u.`{c}`" for c in df.columns]
    right_cols = [f"coalesce(m.`{c}`, {lit(defaults[c])}) AS `{c}`" if c in filled else f"m.`{c}`"
                  for c in dim.columns if c not in keys]
    cond = " AND ".join(f"u.`{k}` = m.`{k}`" for k in keys)
    text = (f"SELECT {hint}" + ", ".join(left_cols + right_cols)
            + f" FROM {{u}} u LEFT JOIN {{m}} m ON {cond}")
    if hint:
        dim = _bounded(dim, dim_row_bound)
    return df.sparkSession.sql(text, u=df, m=dim)


def _bounded(dim: DataFrame, rows: int) -> DataFrame:
    """``dim``, raising when it has more than ``rows`` rows.

    At most ``rows + 1`` rows are numbered, in one task; that is what a broadcast
    would collect anyway.
    """
    names = ", ".join(f"`{c}`" for c in dim.columns)
    return dim.sparkSession.sql(
        f"SELECT {names} FROM (SELECT *, row_number() OVER (ORDER BY 1) AS __n FROM (SELECT * FROM {{d}} LIMIT {rows + 1})) "
        f"WHERE __n <= {rows} OR raise_error('the lookup side has more than {rows} rows') IS NULL", d=dim)
