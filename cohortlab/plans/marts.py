"""Stored marts: the model-build job and its refresh by cycle (SNK1-SNK5 over M1-M6, M9, M10).

The five respondent tables that M1 joins are stored by respondent first, in
partitions of the cycle's range bucket; M1, M2 and M3 are stored by respondent as
well. From there on M1, M3, M4 and M6 join and group without an exchange. The cohort is
clustered for its reports instead, and M5 is merged from parts, a row per cycle and group.

A respondent belongs to one cycle, so no model joins rows of two cycles: a changed cycle
is rebuilt from its own partitions alone (:func:`refresh_cycles`), and only the models that
read something changed are rebuilt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions.sql import project, q
from cohortlab.plans import checks
from cohortlab.plans import flow as FL
from cohortlab.plans import models as M
from cohortlab.plans.docs import TABLES, column_texts
from cohortlab.plans.staging import STAGED, view_text
from cohortlab.sinks.tables import ddl
from cohortlab.sinks.warehouse import BUCKET, Layout, Warehouse, bucket_number, bucket_of
from cohortlab.sources import seeds

KEY = M.KEY
YEAR = "cycle_start_year"
# respondent tables that M1 joins: staging view -> published table
INPUTS = {"stg_demo": "keyed_demo", "stg_dr1tot": "keyed_dr1tot", "stg_dr2tot": "keyed_dr2tot",
          "stg_glu": "keyed_glu", "stg_mortality": "keyed_mortality"}
# table: (bucketed by, sorted by, partitioned by the range of)
LAYOUTS = {
    **{t: (KEY, (), YEAR) for t in INPUTS.values()},
    "respondent_daily": (KEY, ("age_band_levine", KEY), YEAR),
    "protein_items": (KEY, (KEY, "protein_source_group"), YEAR),
    "protein_source_estimates": (KEY, (), YEAR),
    "validation_cohort": (None, ("age_band_levine", "protein_group_day_1"), YEAR),
    "validation_summary_parts": (None, (), YEAR),
    "cycle_protein_trends": (None, (), YEAR),
    "validation_summary": (None, (), None),
    "flow_cohort": (None, ("PAPER_AGE_BAND", "PROTEIN_GROUP_DAY1"), "CYCLE_START_YEAR"),
    "flow_summary": (None, (), None),
    "spoilt_cohort": (None, (), YEAR),
}
# What each model of the refresh reads, in build order.
READS = {
    "respondent_daily": tuple(INPUTS.values()),
    "protein_items": ("stg_dr1iff", "stg_dr2iff"),
    "protein_source_estimates": ("protein_items",),
    "validation_cohort": ("respondent_daily", "protein_source_estimates"),
    "cycle_protein_trends": ("respondent_daily", "protein_source_estimates"),
    "validation_summary_parts": ("validation_cohort",),
    "validation_summary": ("validation_summary_parts",),
}
# Models whose tasks hold whole buckets already when they are written.
ALIGNED = ("respondent_daily", "protein_source_estimates")


def layout_of(name: str, columns: Sequence[str]) -> Layout:
    key, cluster, year = LAYOUTS[name]
    not_null, accepted = checks.COUNTED.get(name, ((), {}))
    return Layout(key, cluster, year, TABLES[name], column_texts(columns), not_null, accepted)


def keyless(wh: Warehouse, name: str) -> bool:
    """Whether a stored table has rows without a key, as counted when it was written."""
    return wh.counted(name).get(f"not_null|{KEY}", 1) > 0


def _builders(wh: Warehouse, rows: Callable[[str], DataFrame], stg: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Each model over ``rows(name)``, the stored rows of a table that it may read."""
    return {
        "respondent_daily": lambda: M.respondent_daily(
            {s: rows(t) for s, t in INPUTS.items()}, stored=True, keyless=keyless(wh, "keyed_demo")),
        "protein_items": lambda: M.protein_items(stg, seeds.group_map(wh.spark)),
        "protein_source_estimates": lambda: M.protein_source_estimates(rows("protein_items")),
        "validation_cohort": lambda: M.validation_cohort(
            rows("respondent_daily"), rows("protein_source_estimates"), stored=True, keyless=keyless(wh, "respondent_daily")),
        "cycle_protein_trends": lambda: M.cycle_protein_trends(
            rows("respondent_daily"), rows("protein_source_estimates"), stored=True, keyless=keyless(wh, "respondent_daily")),
        "validation_summary_parts": lambda: M.summary_parts(rows("validation_cohort")),
        "validation_summary": lambda: M.merged_summary(wh.stored("validation_summary_parts")),
    }


def stored_bytes(spark: SparkSession, path: str) -> int:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def build_warehouse(spark: SparkSession, landed: Mapping[str, DataFrame], stg: Mapping[str, DataFrame],
                    database: str, root: str, buckets: int | None = None) -> Warehouse:
    """Landing tables and staging views by name, then all tables, published."""
    if buckets is None:
        # the items of both days are one table
        tables = [[landed[STAGED[s][0]]] for s in INPUTS] + [[landed["dr1iff"], landed["dr2iff"]]]
        buckets = bucket_number(max(sum(stored_bytes(spark, f) for df in t for f in _roots(df)) for t in tables),
                                rows=max(sum(df.count() for df in t) for t in tables))
    wh = Warehouse(spark, database, root, buckets)
    register_staging(wh, landed)

    def put(name: str, df: DataFrame, aligned: bool = False) -> None:
        wh.publish(name, df, layout_of(name, df.columns), aligned)

    builders = _builders(wh, wh.stored, stg)
    model = lambda name: put(name, builders[name](), name in ALIGNED)
    with ThreadPoolExecutor(max_workers=4) as pool:
        # independent roots at once: the stored inputs, the items, the flow's cohort
        jobs = [pool.submit(put, table, stg[view]) for view, table in INPUTS.items()]
        jobs += [pool.submit(model, "protein_items"), pool.submit(put, "flow_cohort", FL.flow_cohort(landed))]
        for j in jobs:
            j.result()
        for level in (["respondent_daily", "protein_source_estimates"], ["validation_cohort", "cycle_protein_trends"],
                      ["validation_summary_parts"], ["validation_summary"]):
            for j in [pool.submit(model, name) for name in level]:
                j.result()
    put("flow_summary", FL.flow_summary(wh.table("flow_cohort")))
    return wh


def _roots(df: DataFrame) -> list[str]:
    """Folders that a file-based DataFrame reads."""
    return sorted({f.rsplit("/", 2)[0] if "=" in f.rsplit("/", 2)[1] else f.rsplit("/", 1)[0] for f in df.inputFiles()})


def register_staging(wh: Warehouse, landed: Mapping[str, DataFrame]) -> None:
    """Landing tables as external tables ``raw_*`` and the staging views over them, by name."""
    for view, (source, _) in STAGED.items():
        if source not in list(landed):
            continue
        df = landed[source]
        raw = wh.sql_name(f"raw_{source}")
        wh.spark.sql(f"DROP TABLE IF EXISTS {raw}")
        by = landed.partition_columns(source)
        wh.spark.sql(f"CREATE TABLE {raw} ({ddl(df)}) USING parquet"
                     + (f" PARTITIONED BY ({', '.join(by)})" if by else "") + f" LOCATION '{landed.location(source)}'")
        if by:
            wh.spark.sql(f"ALTER TABLE {raw} RECOVER PARTITIONS")
        wh.spark.sql(f"CREATE OR REPLACE VIEW {wh.sql_name(view)} AS {view_text(view, raw)}")


# ------------------------------------------------------------ refresh by cycle
def to_rebuild(changed: Iterable[str]) -> list[str]:
    """Models that read a changed table, directly or not, in build order."""
    dirty = set(changed)
    for name, sources in READS.items():
        if dirty.intersection(sources):
            dirty.add(name)
    return [name for name in READS if name in dirty]


def refresh_cycles(wh: Warehouse, years: Sequence[int], changed: Mapping[str, DataFrame],
                   items: Mapping[str, DataFrame] | None = None) -> list[str]:
    """Rebuild what depends on the ``changed`` staging rows of some cycles, and nothing else.

    ``changed``: staging view -> its new rows of exactly these cycles (stored inputs of M1).
    ``items``: both item views restricted to these cycles, if foods changed. Partitions
    of other cycles are neither read nor written; M5 merges the parts of all cycles.
    Returns the rebuilt models.
    """
    cycles = sorted({bucket_of(y) for y in years})
    listed = ", ".join(map(str, sorted(years)))
    for view, rows in changed.items():
        table = INPUTS[view]
        # an overflow bucket holds several cycles: rows of the others stay
        others = wh.cycle(table, cycles).where(f"{YEAR} NOT IN ({listed})").select(*rows.columns)
        wh.replace(table, rows.unionByName(others), cycles)
    names = to_rebuild([INPUTS[v] for v in changed] + (list(items) if items else []))
    builders = _builders(wh, lambda name: wh.cycle(name, cycles), items or {})
    for name in names:
        df = builders[name]()
        if LAYOUTS[name][2] is None:
            wh.publish(name, df, wh.layouts[name])
        else:
            wh.replace(name, df.drop(BUCKET), cycles, name in ALIGNED)
    return names


def spoil(cohort: DataFrame) -> DataFrame:
    """The cohort with every tenth respondent's age band replaced by one of four wrong ones."""
    wrong = "CASE WHEN respondent_id % 10 = 3 THEN concat('BAND_', respondent_id % 4) ELSE age_band_levine END AS age_band_levine"
    return project(cohort, [KEY, YEAR, wrong, q("protein_group_day_1")])
