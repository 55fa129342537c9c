"""Warehouse-faithful casts and composite keys (PRJ1-PRJ6, FN1).

Every helper takes Spark SQL expression text and returns expression text, so
a whole projection is handed to the JVM in one call (``selectExpr`` /
:func:`cohortlab.functions.sql.project`) and stays inside whole-stage codegen.
Wrap a result in ``F.expr`` to get a Column.
"""

from __future__ import annotations

# NUMERIC in the source warehouse: 38 digits, scale 9.
NUMERIC = "decimal(38,9)"


def safe_int(x: str) -> str:
    """``safe_cast(x as int64)``: rounds half away from zero, NULL on failure.

    A plain cast truncates (2.5 -> 2); rounding first gives 3 and -3 for -2.5.
    NaN and infinities become NULL.
    """
    return f"try_cast(round({x}) as bigint)"


def safe_numeric(x: str) -> str:
    """``safe_cast(x as numeric)``: decimal(38,9), NULL on failure."""
    return f"try_cast({x} as {NUMERIC})"


def float_text(x: str) -> str:
    """Text form of a float the way the warehouse prints it.

    Integral values print without a fraction (``21005``, not ``21005.0``);
    other values use the default text form.
    """
    return (f"(case when ({x}) % 1 = 0 then cast(try_cast({x} as bigint) as string) "
            f"else cast({x} as string) end)")


def composite_key(*parts: str, sep: str = "|") -> str:
    """``concat(a, '|', b, ...)``; NULL if any part is NULL (unlike concat_ws)."""
    return "concat(" + f", '{sep}', ".join(parts) + ")"


def respondent_key(seqn: str = "seqn", start: str = "cycle_start_year", end: str = "cycle_end_year") -> str:
    """``seqn|cycle_start|cycle_end`` with the float parts printed as integers."""
    return composite_key(float_text(seqn), f"cast({start} as string)", f"cast({end} as string)")


def item_key(seqn: str, start: str, end: str, day: int, line: str) -> str:
    """``seqn|start|end|day|line`` with the recall day as a literal."""
    return composite_key(float_text(seqn), f"cast({start} as string)", f"cast({end} as string)",
                         f"'{day}'", float_text(line))


def padded_code(code: str, width: int = 8) -> str:
    """``lpad(cast(code as string), 8, '0')`` for non-NULL codes.

    Like the warehouse, lpad also truncates codes longer than ``width``.
    """
    return f"(case when {code} is not null then lpad(cast({code} as string), {width}, '0') end)"


def leading_digit(padded: str) -> str:
    """``safe_cast(substr(padded, 1, 1) as int64)``."""
    return f"try_cast(substring({padded}, 1, 1) as bigint)"
