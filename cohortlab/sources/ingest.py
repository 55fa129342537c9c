"""Landing ingestion: loader metadata, cycle unions, fixed-width mortality files.

SRC2/SRC3: the mortality ``.dat`` files are fixed-width text. They are read
with ``spark.read.text`` (splittable line input) and sliced with
``substring``, so parsing is whole-stage-codegen JVM work with no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions.bands import lit
from cohortlab.functions.sql import project, q
from cohortlab.operators.reshape import union_all_by_name

# Zero-based half-open column spans of the mortality file.
MORTALITY_SPANS = [
    ("SEQN", 0, 14),
    ("ELIGSTAT", 14, 15),
    ("MORTSTAT", 15, 16),
    ("UCOD_LEADING", 16, 19),
    ("DIABETES", 19, 20),
    ("HYPERTEN", 20, 21),
    ("PERMTH_INT", 42, 45),
    ("PERMTH_EXM", 45, 48),
]
MORTALITY_TEXT_COLUMNS = {"UCOD_LEADING"}
MORTALITY_LINE_WIDTH = 48


def add_common_metadata(df: DataFrame, cycle_start: int, cycle_end: int, source_url: str,
                        file_code: str, asset_type: str) -> DataFrame:
    """Upper-case every column name and add the six loader constants (ING1)."""
    return project(df, [
        *[f"{q(c)} AS {q(c.upper())}" for c in df.columns],
        f"cast({cycle_start} as bigint) AS CYCLE_START_YEAR",
        f"cast({cycle_end} as bigint) AS CYCLE_END_YEAR",
        f"{lit(f'{cycle_start}-{cycle_end}')} AS CYCLE_LABEL",
        f"{lit(file_code)} AS FILE_CODE",
        f"{lit(asset_type)} AS ASSET_TYPE",
        f"{lit(source_url)} AS SOURCE_URL",
    ])


def union_cycles(frames: Sequence[DataFrame]) -> DataFrame:
    """All cycles of one asset in one table; columns missing in a cycle become NULL (ING2)."""
    return union_all_by_name(list(frames), allow_missing=True)


def file_code_for(template: str, suffix: str, overrides: dict[str, str] | None = None) -> str:
    """``DEMO_{suffix}`` style file code with per-suffix overrides (ING4)."""
    return (overrides or {}).get(suffix, template.format(suffix=suffix))


def mortality_field_exprs(text_col: str = "value") -> list[str]:
    """Typed columns sliced from a fixed-width mortality line.

    Numeric fields: trimmed, bad text (such as ``.``) -> NULL. The cause code
    is only trimmed (a ``.`` stays text; a blank field is NULL).
    """
    out = []
    for name, start, end in MORTALITY_SPANS:
        raw = f"trim(substring({text_col}, {start + 1}, {end - start}))"
        if name in MORTALITY_TEXT_COLUMNS:
            out.append(f"nullif({raw}, '') AS {name}")
        else:
            out.append(f"try_cast({raw} as double) AS {name}")
    return out


def parse_mortality_lines(lines: DataFrame, text_col: str = "value",
                          keep: Sequence[str] = ()) -> DataFrame:
    """Slice fixed-width mortality lines into typed columns; blank lines are skipped.

    ``keep`` columns are carried through unchanged.
    """
    return project(lines, [*mortality_field_exprs(text_col), *[q(k) for k in keep]],
                   where=f"trim({text_col}) <> ''")


def read_mortality_files(spark: SparkSession, path: str, releases: DataFrame | None = None) -> DataFrame:
    """Fixed-width mortality files (glob or folder) as landing rows.

    Cycle, file code and source come from each file's path; files whose path
    names no cycle are skipped. The release year is that of the file name, or the
    cycle's newest in ``releases`` (cycle_start_year, latest_release_year).
    """
    raw = (spark.read.option("recursiveFileLookup", "true").text(path)
           .selectExpr("value", "_metadata.file_path AS path"))
    code = r"regexp_extract(path, '([A-Za-z]+_\\d{4}_\\d{4}_MORT_\\d{4}_PUBLIC)', 1)"
    year = lambda i: f"cast(regexp_extract(path, '_(\\\\d{{4}})_(\\\\d{{4}})_MORT_(\\\\d{{4}})_PUBLIC', {i}) as bigint)"
    rows = project(raw, [*mortality_field_exprs("value"), f"{year(1)} AS CYCLE_START_YEAR", f"{year(2)} AS CYCLE_END_YEAR",
                         f"concat({year(1)}, '-', {year(2)}) AS CYCLE_LABEL", f"{code} AS FILE_CODE",
                         "'mortality' AS ASSET_TYPE", f"concat('landing/mortality/', {code}, '.dat') AS SOURCE_URL",
                         f"{year(3)} AS MORTALITY_PUBLIC_RELEASE_YEAR"],
                   where=f"trim(value) <> '' AND {code} <> ''")
    if releases is None:
        return rows
    text = ("SELECT m.* EXCEPT (MORTALITY_PUBLIC_RELEASE_YEAR), r.latest_release_year AS MORTALITY_PUBLIC_RELEASE_YEAR "
            "FROM {m} m JOIN {r} r ON m.CYCLE_START_YEAR = r.cycle_start_year "
            "AND m.MORTALITY_PUBLIC_RELEASE_YEAR = r.latest_release_year")
    return spark.sql(text, m=rows, r=releases)


def _field(x: str, width: int, missing: str) -> str:
    """Right-aligned text field of ``width``; ``missing`` fills it for NULL."""
    txt = (f"(CASE WHEN ({x}) IS NULL THEN {lit(missing)} WHEN ({x}) % 1 = 0 "
           f"THEN cast(cast({x} as bigint) as string) ELSE cast({x} as string) END)")
    return f"lpad({txt}, {width}, ' ')"


def format_mortality_line(seqn: str, eligstat: str, mortstat: str, ucod: str, diabetes: str,
                          hyperten: str, permth_int: str, permth_exm: str) -> str:
    """One record in the fixed-width layout ('.' for missing numerics), as expression text."""
    return ("concat(" + ", ".join([
        _field(seqn, 14, "."), _field(eligstat, 1, "."), _field(mortstat, 1, "."),
        f"rpad(coalesce({ucod}, ''), 3, ' ')", _field(diabetes, 1, "."), _field(hyperten, 1, "."),
        lit(" " * 21), _field(permth_int, 3, "."), _field(permth_exm, 3, "."),
    ]) + ")")
