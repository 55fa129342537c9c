"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Every query derives its inputs from the driver tables under ``sf_dir``
(whole tables, no sampling) and ends with :func:`present`, which turns
decimals into doubles and rounds doubles to 6 places so results compare
exactly with the DuckDB oracle.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlab.functions.sql import project, q

from cohortlab.plans import flow as FL
from cohortlab.plans import models as M
from cohortlab.plans import reports as RP
from cohortlab.plans import marts as MB
from cohortlab.plans.staging import Staged, staged
from cohortlab.session import checkpoint_dir
from cohortlab.sinks.warehouse import Warehouse
from cohortlab.sources.landing import Landed, landed_tables

ROUND_PLACES = 6


def present(df: DataFrame, places: int = ROUND_PLACES) -> DataFrame:
    """Decimal -> double, doubles rounded to ``places``; other columns unchanged."""
    exprs = []
    for f in df.schema.fields:
        name = q(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            exprs.append(f"round(cast({name} as double), {places}) AS {name}")
        elif isinstance(f.dataType, T.DoubleType):
            exprs.append(f"round({name}, {places}) AS {name}")
        else:
            exprs.append(name)
    return project(df, exprs)


# Staging views and the model DAG are lazy plan objects; like views they are
# defined once per application and version of the data folder and shared by every
# query (no data is cached: each action reads the landed Parquet again).
_PLANS: dict[tuple[str, Landed], object] = {}
_PLANS_LOCK = threading.RLock()  # dag() builds stage() under the lock


def _memo(kind: str, spark: SparkSession, sf_dir: str, build):
    landed = landed_tables(spark, sf_dir)
    with _PLANS_LOCK:
        if (kind, landed) not in _PLANS:
            _PLANS[kind, landed] = build(landed)
        return _PLANS[kind, landed]


def stage(spark: SparkSession, sf_dir: str) -> Staged:
    return _memo("stage", spark, sf_dir, staged)


def dag(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _memo("dag", spark, sf_dir, lambda _: M.build_all(spark, stage(spark, sf_dir)))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All models built once and published under a database of their own for each folder and version."""
    def build(landed: Landed) -> Warehouse:
        mark = os.path.basename(landed.root)
        return MB.build_warehouse(spark, landed, stage(spark, sf_dir), f"cohort_{mark}", os.path.join(checkpoint_dir(spark), "marts", mark))

    return _memo("warehouse", spark, sf_dir, build)


def stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """M1-M6, M9 and M10 as published."""
    wh = warehouse(spark, sf_dir)
    return _memo("marts", spark, sf_dir, lambda _: {name: wh.table(name) for name in wh.layouts})


def _stored_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports read the cohort mart, as the dashboard does."""
    return stored_marts(spark, sf_dir)["validation_cohort"]


def _flow_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _memo("flow", spark, sf_dir, FL.flow_cohort)


def _shown(kind: str, build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query's presented plan, defined once per folder like the views it reads."""
    return lambda spark, sf_dir: _memo(f"shown-{kind}", spark, sf_dir, lambda _: present(build(spark, sf_dir)))


def _staged(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return _shown(name, lambda spark, sf_dir: stage(spark, sf_dir)[name])


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return _shown(name, lambda spark, sf_dir: dag(spark, sf_dir)[name])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # staging (STG1-STG7)
    "stg_demo": _staged("stg_demo"),
    "stg_totals_day_1": _staged("stg_dr1tot"),
    "stg_totals_day_2": _staged("stg_dr2tot"),
    "stg_items_day_1": _staged("stg_dr1iff"),
    "stg_items_day_2": _staged("stg_dr2iff"),
    "stg_glucose": _staged("stg_glu"),
    "stg_mortality": _staged("stg_mortality"),
    # models (M1-M6)
    "respondent_daily": _model("respondent_daily"),
    "protein_items": _model("protein_items"),
    "protein_source_estimates": _model("protein_source_estimates"),
    "validation_cohort": _model("validation_cohort"),
    "validation_summary": _model("validation_summary"),
    "cycle_trends": _model("cycle_protein_trends"),
    # dashboard reports (M7, M8)
    "mortality_rates_long": _shown("mortality_rates_long", lambda spark, d: RP.mortality_rates_long(_stored_cohort(spark, d))),
    "source_rates_long": _shown("source_rates_long", lambda spark, d: RP.source_rates_long(_stored_cohort(spark, d))),
    # orchestrator flow (M9, M10)
    "flow_cohort": _shown("flow_cohort", _flow_cohort),
    "flow_summary": _shown("flow_summary", lambda spark, d: FL.flow_summary(_flow_cohort(spark, d))),
}

# Operator-level queries.
from cohortlab.plans.operator_queries import OPERATOR_QUERIES  # noqa: E402

for _name, _fn in OPERATOR_QUERIES.items():
    QUERIES[_name] = (lambda f: lambda spark, d: present(f(spark, d)))(_fn)
