"""Landing tables derived from the driver's star-schema tables.

The engine's models read eight landing tables (demo, day-1/day-2 totals,
day-1/day-2 items, glucose, mortality, source catalog). The driver ships
TPC-H-like tables instead of survey files, so this module projects them
deterministically into the landing shapes (FIXTURES.md section 3). The
projections only use integer, floor and power-of-two arithmetic, so every
sum is exact in any order.

Scale notes: demo, glucose and mortality are narrow projections of
``customer`` (no shuffle). Items join ``lineitem`` to ``orders`` on the order
key and aggregate per order line; the aggregation keys contain the join key,
so the aggregation reuses the join's hash partitioning instead of shuffling
again. Day totals aggregate the items per respondent and day with a
map-side partial aggregate.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions.sql import aggregate, project
from cohortlab.session import checkpoint_dir
from cohortlab.sinks.tables import ddl
from cohortlab.sources import catalog as CAT

# The eight survey cycles (start year, end year, file suffix),
# the asset file-code templates and their per-cycle override.
CYCLES = [
    (2003, 2004, "C"), (2005, 2006, "D"), (2007, 2008, "E"), (2009, 2010, "F"),
    (2011, 2012, "G"), (2013, 2014, "H"), (2015, 2016, "I"), (2017, 2018, "J"),
]
ASSET_TEMPLATES = {
    "demo": "DEMO_{suffix}",
    "dr1tot": "DR1TOT_{suffix}",
    "dr2tot": "DR2TOT_{suffix}",
    "dr1iff": "DR1IFF_{suffix}",
    "dr2iff": "DR2IFF_{suffix}",
    "glu": "GLU_{suffix}",
}
ASSET_OVERRIDES = {("glu", "C"): "L10AM_C"}
MORTALITY_RELEASE_YEAR = 2019
# Where landed files live relative to the landing root (files are already
# landed; the engine does not download).
LANDING_URL_TEMPLATE = "landing/{start}/{file_code}.xpt"

DRIVER_TABLES = ("customer", "orders", "lineitem", "pages")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(expr: str) -> str:
    return f"cast({expr} as double)"


def cycle_exprs(k: str = "k") -> list[str]:
    """Cycle start/end/label of respondent ``k`` (cycle = k mod 8)."""
    start = f"(2003 + 2 * ({k} % 8))"
    return [f"cast({start} as bigint) AS CYCLE_START_YEAR",
            f"cast({start} + 1 as bigint) AS CYCLE_END_YEAR",
            f"concat(cast({start} as string), '-', cast({start} + 1 as string)) AS CYCLE_LABEL"]


def _suffix(k: str = "k") -> str:
    return f"char(67 + {k} % 8)"  # C..J


def xpt_meta_exprs(asset: str, k: str = "k") -> list[str]:
    """FILE_CODE / ASSET_TYPE / SOURCE_URL of an XPT asset for respondent ``k``."""
    prefix = ASSET_TEMPLATES[asset].split("{")[0]
    code = f"concat('{prefix}', {_suffix(k)})"
    for (a, sfx), override in ASSET_OVERRIDES.items():
        if a == asset:
            code = f"(CASE WHEN {_suffix(k)} = '{sfx}' THEN '{override}' ELSE {code} END)"
    return [f"{code} AS FILE_CODE", f"'{asset}' AS ASSET_TYPE",
            f"concat('landing/', cast(2003 + 2 * ({k} % 8) as string), '/', {code}, '.xpt') AS SOURCE_URL"]


def demo(customer: DataFrame) -> DataFrame:
    k = "c_custkey"
    return project(customer, [
        f"{_d(k)} AS SEQN",
        f"{_d(f'3 + {k} % 8')} AS SDDSRVYR",
        f"CASE WHEN {k} % 83 <> 82 THEN {_d(f'({k} * 7) % 86')} END AS RIDAGEYR",
        f"{_d(f'1 + {k} % 2')} AS RIAGENDR",
        f"{_d('1 + c_nationkey % 5')} AS RIDRETH1",
        f"{_d(f'1 + {k} % 5')} AS DMDEDUC2",
        f"{_d(f'{k} % 41')} / 8.0D AS INDFMPIR",
        f"{_d(f'1 + {k} % 2')} AS SDMVPSU",
        f"{_d(f'100 + {k} % 15')} AS SDMVSTRA",
        f"{_d(f'1000 + ({k} * 13) % 5000')} AS WTINT2YR",
        f"{_d(f'1000 + ({k} * 17) % 5000')} AS WTMEC2YR",
        *cycle_exprs(k), *xpt_meta_exprs("demo", k),
    ])


def item_base(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order line: respondent k, recall day, line and its measures.

    Grouping keys include ``l_orderkey`` so, when the join is a shuffle join,
    the aggregate is satisfied by the join's partitioning (one exchange per
    input, none after the join).
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    od = orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey AS k")
    joined = li.join(od, "l_orderkey")
    return aggregate(
        joined, ["l_orderkey", "l_linenumber", "k"],
        ["max(l_partkey) AS pk", "sum(l_quantity) AS q", "sum(floor(l_extendedprice)) AS p"],
    ).selectExpr("k", "1 + l_orderkey % 2 AS day", "l_orderkey * 10 + l_linenumber AS line", "pk", "q", "p")


def _w1(k: str = "k") -> str:
    return f"CASE WHEN {k} % 31 <> 30 THEN {_d(f'1000 + ({k} * 19) % 6000')} END"


def _w2(k: str = "k") -> str:
    return _d(f"1000 + ({k} * 23) % 6000")


def items(base: DataFrame, day: int) -> DataFrame:
    """dr1iff / dr2iff landing rows for one recall day."""
    pre = f"DR{day}I"
    cols = [
        f"{_d('k')} AS SEQN",
        f"{_d('line')} AS DR{day}ILINE",
        f"CASE WHEN pk % 101 <> 0 THEN {_d('(pk % 11) * 10000000 + pk')} END AS {pre}FDCD",
    ]
    if day == 1:
        cols.append(f"{_w1()} AS WTDRD1")
    cols += [
        f"{_w2()} AS WTDR2D",
        f"q * 4 AS {pre}GRMS",
        f"{_d('CASE WHEN k % 17 <> 0 THEN floor(p / (200 * (1 + k % 4))) ELSE 0 END')} AS {pre}KCAL",
        f"CASE WHEN pk % 97 <> 0 THEN q / 8.0D END AS {pre}PROT",
        f"q / 4.0D AS {pre}CARB",
        f"q / 16.0D AS {pre}TFAT",
        f"{_d('1 + pk % 9')} AS DR{day}_030Z",
        f"{_d('1 + pk % 2')} AS DR{day}_040Z",
        *cycle_exprs("k"), *xpt_meta_exprs(f"dr{day}iff", "k"),
    ]
    return project(base, cols, where=f"day = {day}")


def day_sums(item_rows: DataFrame, day: int) -> DataFrame:
    """The day's item sums per respondent k.

    A respondent's row is absent for ``k % 19 = 0`` (day 1) or
    ``k % 13 = 0`` (day 2).
    """
    pre = f"DR{day}I"
    skip = 19 if day == 1 else 13
    return aggregate(
        item_rows, ["cast(SEQN as bigint) AS k"],
        [f"sum({pre}KCAL) AS DR{day}TKCAL", f"sum({pre}PROT) AS DR{day}TPROT",
         f"sum({pre}CARB) AS DR{day}TCARB", f"sum({pre}TFAT) AS DR{day}TTFAT"],
        where=f"cast(SEQN as bigint) % {skip} <> 0")


def total_rows(sums: DataFrame, day: int) -> DataFrame:
    """dr1tot / dr2tot landing rows of :func:`day_sums`."""
    return project(sums, [
        f"{_d('k')} AS SEQN",
        f"{_w1() if day == 1 else _w2()} AS {'WTDRD1' if day == 1 else 'WTDR2D'}",
        f"1.0D AS DR{day}DRSTZ",
        f"DR{day}TKCAL", f"DR{day}TPROT", f"DR{day}TCARB", f"DR{day}TTFAT",
        *cycle_exprs("k"), *xpt_meta_exprs(f"dr{day}tot", "k"),
    ])


def totals(item_rows: DataFrame, day: int) -> DataFrame:
    """dr1tot / dr2tot: the day's item sums per respondent."""
    return total_rows(day_sums(item_rows, day), day)


def glucose(customer: DataFrame) -> DataFrame:
    k = "c_custkey"
    glu = f"CASE WHEN {k} % 23 <> 0 THEN {_d(f'70 + ({k} * 11) % 90')} END"
    return project(customer, [
        f"{_d(k)} AS SEQN",
        f"{_d(f'2000 + ({k} * 29) % 7000')} AS WTSAF2YR",
        f"{glu} AS LBXGLU",
        f"{glu} / 16.0D AS LBDGLUSI",
        f"{_d(f'8 + {k} % 8')} AS PHAFSTHR",
        f"{_d(f'{k} % 60')} AS PHAFSTMN",
        f"{_d(f'{k} % 40')} / 2.0D AS LBXIN",
        f"{_d(f'{k} % 40')} * 3.0D AS LBDINSI",
        *cycle_exprs(k), *xpt_meta_exprs("glu", k),
    ], where=f"{k} % 3 <> 0")


def mortality_exprs(k: str) -> list[str]:
    """The mortality record of respondent ``k`` as ``expr AS NAME`` texts."""
    mortstat = f"CASE WHEN {k} % 10 <> 0 THEN (CASE WHEN {k} % 4 = 1 THEN 1.0D ELSE 0.0D END) END"
    dead = f"({mortstat}) = 1.0D"
    permth = _d(f"({k} * 5) % 190")
    return [
        f"{_d(k)} AS SEQN",
        f"CASE WHEN {k} % 10 <> 0 THEN 1.0D ELSE 2.0D END AS ELIGSTAT",
        f"{mortstat} AS MORTSTAT",
        f"CASE WHEN {dead} THEN lpad(cast(1 + floor({k} / 4) % 10 as string), 3, '0') END AS UCOD_LEADING",
        f"CASE WHEN {dead} THEN (CASE WHEN {k} % 7 = 1 THEN 1.0D ELSE 0.0D END) END AS DIABETES",
        f"CASE WHEN {dead} THEN (CASE WHEN {k} % 5 = 1 THEN 1.0D ELSE 0.0D END) END AS HYPERTEN",
        f"{permth} AS PERMTH_INT",
        f"greatest({permth} - 1, 0.0D) AS PERMTH_EXM",
    ]


def mortality_file_code(start: str, end: str, release: str, prefix: str = "SURVEY") -> str:
    """``<prefix>_<start>_<end>_MORT_<release>_PUBLIC`` (file name without .dat)."""
    return f"format_string('{prefix}_%d_%d_MORT_%d_PUBLIC', {start}, {end}, {release})"


def mortality(customer: DataFrame) -> DataFrame:
    k = "c_custkey"
    start, end = f"(2003 + 2 * ({k} % 8))", f"(2004 + 2 * ({k} % 8))"
    code = mortality_file_code(start, end, str(MORTALITY_RELEASE_YEAR))
    return project(customer, [
        *mortality_exprs(k), *cycle_exprs(k),
        f"{code} AS FILE_CODE", "'mortality' AS ASSET_TYPE",
        f"concat('landing/mortality/', {code}, '.dat') AS SOURCE_URL",
        f"cast({MORTALITY_RELEASE_YEAR} as bigint) AS MORTALITY_PUBLIC_RELEASE_YEAR",
    ], where=f"{k} % 29 <> 0")


def cycles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, e) for s, e, _ in CYCLES], "cycle_start_year long, cycle_end_year long")


def release_listing(customer: DataFrame) -> DataFrame:
    """Release listing text: one file name per respondent, of one of three releases."""
    k = "c_custkey"
    name = mortality_file_code(f"2003 + 2 * ({k} % 8)", f"2004 + 2 * ({k} % 8)", f"2011 + 4 * (cast(floor({k} / 8) as bigint) % 3)")
    return project(customer, [f"concat('<a href=\"', {name}, '.dat\">') AS listing"])


def release_pages(pages: DataFrame) -> DataFrame:
    """Every page, a third of them with the sentence that names a horizon."""
    page = ("CASE WHEN page_id % 3 = 0 THEN concat(html, '<p>Updated with mortality follow-up data through December 31, ', "
            "2010 + page_id % 10, '.</p>') ELSE html END")
    return project(pages, ["page_id", f"{page} AS html"])


def file_codes(asset: str) -> list[tuple[int, str]]:
    """(cycle start year, file code) of every file that an asset has, whether it holds rows or not."""
    if asset == "mortality":
        return [(s, f"SURVEY_{s}_{e}_MORT_{MORTALITY_RELEASE_YEAR}_PUBLIC") for s, e, _ in CYCLES]
    return [(s, ASSET_OVERRIDES.get((asset, x), ASSET_TEMPLATES[asset].format(suffix=x))) for s, _, x in CYCLES]


# ---------------------------------------------------------------- landed copies
def by_cycle(df: DataFrame, k: str) -> DataFrame:
    """Rows dealt by the cycle of respondent ``k``, before they are widened to landing rows."""
    return project(df, [*[f"`{c}`" for c in df.columns], cycle_exprs(k)[0]]).hint("rebalance", "CYCLE_START_YEAR")


ASSETS = ("demo", "dr1iff", "dr2iff", "dr1tot", "dr2tot", "glu", "mortality")
CATALOG = "source_catalog"
LANDING_NAMES = (*ASSETS, CATALOG)
FILE_COLUMNS = ("CYCLE_START_YEAR", "FILE_CODE")  # an asset's files: one folder each
# (application, folder, input version) -> landed tables
_LANDED: dict[tuple[str, str, str], "Landed"] = {}
_LAND_LOCK = threading.RLock()


def input_version(spark: SparkSession, sf_dir: str) -> str:
    """Sizes and times of the driver files, so that changed input is landed anew."""
    jvm = spark.sparkContext._jvm
    seen = []
    for name in DRIVER_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in fs.listStatus(path):
            seen.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(seen)).encode()).hexdigest()[:16]


class Landed(Mapping):
    """The landing tables of one folder; a table is written when it is first asked for.

    A copy lies in the cluster's shared folder, partitioned by cycle start year and file
    code: it survives lost executors, cuts the derivation's lineage, and models read it
    with column and partition pruning. Rows are rebalanced by cycle before the
    write, while they are narrow, so a task writes few files and a large cycle goes to
    several tasks. A source file without rows leaves an empty file. The eighth table, the catalog, is made
    from the names of the landed files; no row is read for it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, root: str) -> None:
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self.schemas: dict[str, str] = {}
        self.frames: dict[str, DataFrame] = {}  # a table's files are listed once

    __hash__ = object.__hash__  # one object per version of a folder
    __eq__ = object.__eq__

    def __iter__(self) -> Iterator[str]:
        return iter(LANDING_NAMES)

    def __len__(self) -> int:
        return len(LANDING_NAMES)

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    def partition_columns(self, name: str) -> tuple[str, ...]:
        return FILE_COLUMNS if name in ASSETS else ()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in LANDING_NAMES:
            raise KeyError(name)
        with _LAND_LOCK:
            if name not in self.schemas:
                self._write(name, self._derived(name), *self.partition_columns(name))
            return self._read(name)

    def files(self) -> DataFrame:
        """asset_type, cycle_start_year, file_code of every landed file, from its path alone."""
        for name in ASSETS:
            self[name]
        return CAT.landed_files(self.spark, self.root, ASSETS)

    def releases(self) -> DataFrame:
        return CAT.latest_release_years(release_listing(self._driver("customer")), "listing", cycles=cycles(self.spark))

    def followups(self) -> DataFrame:
        return project(release_pages(self._driver("pages")), ["page_id", f"{CAT.followup_text('html')} AS followup_through"])

    def _derived(self, name: str) -> DataFrame:
        if name == CATALOG:
            return CAT.source_catalog(self.files(), self.releases(), self.followups())
        if name in ("demo", "glu", "mortality"):
            customer = by_cycle(project(self._driver("customer"), ["c_custkey", "c_nationkey"]), "c_custkey")
            return {"demo": demo, "glu": glucose, "mortality": mortality}[name](customer)
        day = int(name[2])
        if name.endswith("tot"):
            return total_rows(by_cycle(day_sums(self[f"dr{day}iff"], day), "k"), day)
        if "_item_base" not in self.schemas:  # the one big join, for both days
            self._write("_item_base", item_base(self._driver("orders"), self._driver("lineitem")))
        return items(by_cycle(self._read("_item_base").where(f"day = {day}"), "k"), day)

    def _driver(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)

    def _write(self, name: str, df: DataFrame, *partitions: str) -> None:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
        (w.partitionBy(*partitions) if partitions else w).parquet(f"{self.root}/{name}")
        if partitions:
            self._add_empty_files(name, df.drop(*partitions))
        self.schemas[name] = ddl(df)

    def _add_empty_files(self, name: str, df: DataFrame) -> None:
        """A file without rows where a source file has none, so that its folder stays listed."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for start, code in file_codes(name):
            folder = f"{self.location(name)}/CYCLE_START_YEAR={start}/FILE_CODE={code}"
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if not path.getFileSystem(conf).exists(path):
                self.spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(folder)

    def _read(self, name: str) -> DataFrame:
        """With the declared schema: the partition column stays bigint."""
        if name not in self.frames:
            self.frames[name] = self.spark.read.schema(self.schemas[name]).parquet(self.location(name))
        return self.frames[name]


def landed_tables(spark: SparkSession, sf_dir: str) -> Landed:
    """The landing tables of a folder, shared by all queries of the application."""
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, input_version(spark, sf_dir))
    with _LAND_LOCK:
        if key not in _LANDED:
            digest = hashlib.sha1("|".join(key).encode()).hexdigest()[:16]
            _LANDED[key] = Landed(spark, sf_dir, os.path.join(checkpoint_dir(spark), "landing", digest))
        return _LANDED[key]


def drop_landed(spark: SparkSession) -> int:
    """Remove this application's landed copies; returns how many there were."""
    jvm, dropped = spark.sparkContext._jvm, 0
    with _LAND_LOCK:
        for key in [k for k in _LANDED if k[0] == spark.sparkContext.applicationId]:
            path = jvm.org.apache.hadoop.fs.Path(_LANDED.pop(key).root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            dropped += 1
    return dropped
