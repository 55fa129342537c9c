"""Aggregate expressions (AGG1-AGG11) as Spark SQL text.

All are ordinary aggregates, so any number of them run in one ``GROUP BY``
with a map-side partial aggregate before the shuffle.
"""

from __future__ import annotations


def conditional_sum(cond: str, value: str, zero: str = "0") -> str:
    """``sum(case when cond then value else 0 end)``."""
    return f"sum(CASE WHEN {cond} THEN {value} ELSE {zero} END)"


def conditional_count(cond: str) -> str:
    """``sum(case when cond then 1 else 0 end)``: 0, never NULL, for an empty match."""
    return f"cast(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) as bigint)"


def weighted_total(weight: str) -> str:
    """``sum(coalesce(w, 0))``."""
    return f"sum(coalesce(cast({weight} as double), 0D))"


def weighted_conditional(flag: str, weight: str, null_weight_as_zero: bool = True) -> str:
    """``sum(case when flag then coalesce(w, 0) else 0 end)``.

    With ``null_weight_as_zero=False`` the weight is used as is, so a NULL
    weight is skipped by ``sum`` (the flow summary's form).
    """
    w = f"coalesce(cast({weight} as double), 0D)" if null_weight_as_zero else f"cast({weight} as double)"
    return f"sum(CASE WHEN {flag} THEN {w} ELSE 0D END)"


def weighted_rate(flag: str, weight: str, per: float = 1000.0) -> str:
    """Weighted rate per ``per``: ``sum(flag ? w : 0) / nullif(sum(w), 0) * per``."""
    w = f"cast({weight} as double)"
    return (f"try_divide(sum(CASE WHEN {flag} THEN {w} ELSE 0D END), nullif(sum({w}), 0D)) "
            f"* {float(per)!r}D")


def mean(c: str) -> str:
    """``avg`` ignoring NULLs, computed in doubles."""
    return f"avg(cast({c} as double))"
