"""Applying expression text to DataFrames with few driver-to-JVM calls.

A projection of many columns is sent as one SQL statement over the input
DataFrame (``spark.sql(..., t=df)``), so building a wide model costs a
handful of JVM calls instead of several per column. The result is an
ordinary DataFrame with the same Catalyst plan a chain of ``select`` calls
would give.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame


def q(name: str) -> str:
    """Quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def _esc(text: str) -> str:
    """Escape braces: the statement goes through ``spark.sql``'s ``{name}`` formatter."""
    return text.replace("{", "{{").replace("}", "}}")


def project(df: DataFrame, exprs: Iterable[str], where: str | None = None) -> DataFrame:
    """``SELECT <exprs> FROM df [WHERE where]`` in one statement."""
    text = "SELECT\n  " + _esc(",\n  ".join(exprs)) + "\nFROM {t}"
    if where:
        text += "\nWHERE " + _esc(where)
    return df.sparkSession.sql(text, t=df)


def aggregate(df: DataFrame, keys: Sequence[str], aggs: Iterable[str], where: str | None = None,
              having: str | None = None) -> DataFrame:
    """``SELECT keys, aggs FROM df [WHERE] GROUP BY keys [HAVING]`` in one statement.

    ``keys`` are expressions with optional ``AS`` aliases; grouping uses
    their ordinal positions.
    """
    cols = [*keys, *aggs]
    text = "SELECT\n  " + _esc(",\n  ".join(cols)) + "\nFROM {t}"
    if where:
        text += "\nWHERE " + _esc(where)
    if keys:
        text += "\nGROUP BY " + ", ".join(str(i + 1) for i in range(len(keys)))
    if having:
        text += "\nHAVING " + _esc(having)
    return df.sparkSession.sql(text, t=df)


def select_list(exprs: Iterable[str]) -> str:
    return ",\n  ".join(exprs)
