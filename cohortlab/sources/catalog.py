"""Source catalog, release-year and follow-up extraction, run manifest (ING4-ING8).

The catalog lists each landed file once, also one without rows: its asset, code, cycle
and source come from the paths of the landed files, its release year from the listing's newest
release of the cycle (an error when there is none), and the follow-up horizon from
the release page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions.bands import lit
from cohortlab.functions.sql import aggregate, project
from cohortlab.plans import notes

CATALOG_COLUMNS = [
    "asset_type", "file_code", "file_format", "cycle_start_year", "cycle_end_year", "cycle_label",
    "source_url", "mortality_public_release_year", "mortality_followup_available_through",
    "paper_comparability_note",
]


def landed_files(spark: SparkSession, root: str, assets: Sequence[str]) -> DataFrame:
    """asset_type, cycle_start_year, file_code of the files below ``root``: a listing, no content is read."""
    paths = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(root).select("path"))
    part = lambda i: f"regexp_extract(path, {lit('/([^/]+)/CYCLE_START_YEAR=([0-9]+)/FILE_CODE=([^/]+)/[^/]+$')}, {i})"
    return aggregate(paths, [f"{part(1)} AS asset_type", f"cast({part(2)} as bigint) AS cycle_start_year", f"{part(3)} AS file_code"], [],
                     where=f"{part(1)} IN ({', '.join(lit(a) for a in assets)})")


def source_catalog(files: DataFrame, releases: DataFrame | None = None,
                   followup: DataFrame | None = None, note: str = notes.CATALOG_NOTE) -> DataFrame:
    """The landed ``files`` (:func:`landed_files`), sorted by start year, asset type, file code.

    ``releases``: (cycle_start_year, latest_release_year), for mortality files;
    ``followup``: rows with a column ``followup_through``, of which the largest
    is stamped on every row. Without them the columns are NULL.
    """
    is_dat = "asset_type = 'mortality'"
    cat = project(files, [
        "asset_type", "file_code", f"CASE WHEN {is_dat} THEN 'DAT' ELSE 'XPT' END AS file_format",
        "cycle_start_year", "cycle_start_year + 1 AS cycle_end_year",
        "concat(cycle_start_year, '-', cycle_start_year + 1) AS cycle_label",
        f"CASE WHEN {is_dat} THEN concat('landing/mortality/', file_code, '.dat') "
        "ELSE concat('landing/', cycle_start_year, '/', file_code, '.xpt') END AS source_url"])
    spark = cat.sparkSession
    rel = releases if releases is not None else spark.createDataFrame([], "cycle_start_year long, latest_release_year long")
    through = followup if followup is not None else spark.createDataFrame([], "followup_through string")
    text = ("SELECT c.*, CASE WHEN file_format = 'DAT' THEN r.latest_release_year END AS mortality_public_release_year, "
            "(SELECT max(followup_through) FROM {f}) AS mortality_followup_available_through, "
            f"{lit(note)} AS paper_comparability_note "
            "FROM {c} c LEFT JOIN {r} r ON c.cycle_start_year = r.cycle_start_year")
    return project(spark.sql(text, c=cat, r=rel, f=through), CATALOG_COLUMNS).orderBy(
        "cycle_start_year", "asset_type", "file_code")


def release_file_pattern(prefix: str = "SURVEY") -> str:
    """Regex of a mortality file name: start year, end year, release year."""
    return prefix + r"_(\d{4})_(\d{4})_MORT_(\d{4})_PUBLIC\.dat"


def latest_release_years(listing: DataFrame, text_col: str, prefix: str = "SURVEY",
                         cycles: DataFrame | None = None) -> DataFrame:
    """Latest release year per cycle found in listing text (ING6).

    Every file name in every listing row is extracted (``regexp_extract_all``),
    exploded and reduced with ``max`` per cycle: a distributed find-all + max.
    With ``cycles`` (cycle_start_year, cycle_end_year) the result has exactly
    these, and a cycle without any release raises at runtime.
    """
    pat = lit(release_file_pattern(prefix))
    names = project(listing, [f"explode(regexp_extract_all({text_col}, {pat}, 0)) AS f"])
    out = aggregate(names, [
        f"cast(regexp_extract(f, {pat}, 1) as bigint) AS cycle_start_year",
        f"cast(regexp_extract(f, {pat}, 2) as bigint) AS cycle_end_year"],
        [f"max(cast(regexp_extract(f, {pat}, 3) as bigint)) AS latest_release_year"])
    if cycles is None:
        return out
    return out.sparkSession.sql(
        "SELECT cycle_start_year, cycle_end_year, coalesce(o.latest_release_year, cast(raise_error(concat("
        "'no public mortality release found for cycle ', cycle_start_year)) as bigint)) AS latest_release_year "
        "FROM {c} c LEFT JOIN {o} o USING (cycle_start_year, cycle_end_year)", c=cycles, o=out)


def latest_release_for_cycle(text: str, start: int, end: int, prefix: str = "SURVEY") -> str:
    """Max release year of one cycle in one text, NULL if none (per-row form)."""
    pat = lit(f"{prefix}_{start}_{end}_MORT_" + r"(\d{4})_PUBLIC\.dat")
    return f"array_max(transform(regexp_extract_all({text}, {pat}, 1), y -> cast(y as int)))"


# Fixed value: the sentence on the release page that names the horizon.
FOLLOWUP_PATTERN = r"(?i)updated with mortality follow-up data through ([^.]+?\d{4})"


def followup_text(text: str) -> str:
    """Follow-up horizon sentence fragment, trimmed; NULL when absent (ING7)."""
    return f"nullif(trim(regexp_extract({text}, {lit(FOLLOWUP_PATTERN)}, 1)), '')"


def run_manifest(catalog: DataFrame, window: str = "2003-2018", linkage_note: str = notes.LINKAGE_NOTE,
                 note: str = notes.CATALOG_NOTE) -> DataFrame:
    """One-row JSON manifest: window, cycles, assets, release year per cycle, horizon, two notes (ING8).

    The catalog is first reduced per cycle, then once more to a single row,
    so every collect is bounded by the number of cycles.
    """
    per_cycle = aggregate(catalog, ["cycle_label"], [
        "max(CASE WHEN asset_type = 'mortality' THEN mortality_public_release_year END) AS y",
        "collect_set(CASE WHEN file_format = 'XPT' THEN asset_type END) AS assets",
        "max(mortality_followup_available_through) AS followup"])
    doc = aggregate(per_cycle, [], [
        "array_sort(collect_list(cycle_label)) AS cycles",
        "array_sort(array_distinct(flatten(collect_list(assets)))) AS survey_assets",
        "map_from_entries(array_sort(collect_list(struct(cycle_label, y)))) AS public_mortality_release_year_by_cycle",
        "max(followup) AS mortality_followup_available_through"])
    return project(doc, [
        f"to_json(struct({lit(window)} AS dataset_window, cycles, survey_assets, "
        "public_mortality_release_year_by_cycle, mortality_followup_available_through, "
        f"{lit(linkage_note)} AS linked_mortality_note, {lit(note)} AS paper_comparability_note)) AS manifest_json"])
