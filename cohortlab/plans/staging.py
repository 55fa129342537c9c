"""Staging models STG1-STG8: one rename-and-cast projection per landing table.

Column references are lower-case; landing names are upper-case and resolve
case-insensitively. Each function is a single projection (no shuffle), so
Catalyst prunes whatever the downstream model does not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from cohortlab.functions.casts import (
    composite_key, float_text, item_key, leading_digit, padded_code, respondent_key, safe_int, safe_numeric,
)
from cohortlab.functions.sql import project


def _common() -> list[str]:
    return [
        f"{respondent_key('seqn', 'cycle_start_year', 'cycle_end_year')} AS respondent_key",
        f"{safe_int('seqn')} AS respondent_id",
        f"{safe_int('cycle_start_year')} AS cycle_start_year",
        f"{safe_int('cycle_end_year')} AS cycle_end_year",
        "cast(cycle_label as string) AS cycle_label",
    ]


SOURCE_COLS = ["cast(file_code as string) AS file_code", "cast(source_url as string) AS source_url"]


def _i(src: str, name: str) -> str:
    return f"{safe_int(src)} AS {name}"


def _n(src: str, name: str) -> str:
    return f"{safe_numeric(src)} AS {name}"


def demo_columns() -> list[str]:
    return [
        *_common(),
        _i("sddsrvyr", "survey_cycle_code"), _i("ridageyr", "age_years"), _i("riagendr", "sex_code"),
        _i("ridreth1", "race_ethnicity_code"), _i("dmdeduc2", "education_code"),
        _n("indfmpir", "poverty_income_ratio"), _i("sdmvpsu", "survey_psu"), _i("sdmvstra", "survey_strata"),
        _n("wtint2yr", "interview_weight_2yr"), _n("wtmec2yr", "mec_weight_2yr"),
        *SOURCE_COLS,
    ]


def totals_columns(day: int) -> list[str]:
    weight = "wtdrd1" if day == 1 else "wtdr2d"
    return [
        *_common(),
        _n(weight, f"day_{day}_recall_weight_2yr"), _i(f"dr{day}drstz", f"day_{day}_recall_status"),
        _n(f"dr{day}tkcal", f"day_{day}_energy_kcal"), _n(f"dr{day}tprot", f"day_{day}_protein_g"),
        _n(f"dr{day}tcarb", f"day_{day}_carb_g"), _n(f"dr{day}ttfat", f"day_{day}_fat_g"),
        *SOURCE_COLS,
    ]


def items_columns(day: int) -> list[str]:
    """Item rows of one recall day with their key and food major group.

    Day 1 carries both the day-1 and the two-day weight; day 2 only its own.
    """
    p = f"dr{day}i"
    food_code = safe_int(f"{p}fdcd")
    padded = padded_code(food_code)
    weights = ([_n("wtdrd1", "day_1_recall_weight_2yr"), _n("wtdr2d", "two_day_recall_weight_2yr")]
               if day == 1 else [_n("wtdr2d", "day_2_recall_weight_2yr")])
    return [
        f"{item_key('seqn', 'cycle_start_year', 'cycle_end_year', day, p + 'line')} AS protein_item_key",
        *_common(),
        _i(f"{p}line", "food_line_number"),
        f"{food_code} AS food_code",
        f"{padded} AS food_code_padded",
        f"{leading_digit(padded)} AS food_code_major_group",
        *weights,
        _n(f"{p}grms", "intake_grams"), _n(f"{p}kcal", "energy_kcal"), _n(f"{p}prot", "protein_g"),
        _n(f"{p}carb", "carb_g"), _n(f"{p}tfat", "fat_g"),
        f"{float_text(f'dr{day}_030z')} AS eating_occasion",
        f"{float_text(f'dr{day}_040z')} AS ate_at_home_response",
        *SOURCE_COLS,
    ]


def glucose_columns() -> list[str]:
    return [
        *_common(),
        _n("wtsaf2yr", "fasting_weight_2yr"), _n("lbxglu", "fasting_glucose_mg_dl"),
        _n("lbdglusi", "fasting_glucose_mmol_l"), _n("phafsthr", "fasting_hours"),
        _n("phafstmn", "fasting_minutes"), _n("lbxin", "fasting_insulin_uuml"),
        _n("lbdinsi", "fasting_insulin_pmol_l"),
        *SOURCE_COLS,
    ]


def mortality_columns() -> list[str]:
    return [
        *_common(),
        _i("eligstat", "eligibility_status"), _i("mortstat", "mortality_status"),
        "cast(ucod_leading as string) AS underlying_cause_group_code",
        _i("diabetes", "diabetes_mentioned_flag"), _i("hyperten", "hypertension_mentioned_flag"),
        _n("permth_int", "followup_months_interview"), _n("permth_exm", "followup_months_exam"),
        _i("mortality_public_release_year", "mortality_public_release_year"),
        *SOURCE_COLS,
    ]


def source_catalog_columns() -> list[str]:
    return [
        composite_key("cast(asset_type as string)", "cast(file_code as string)",
                      "cast(cycle_start_year as string)", "cast(cycle_end_year as string)")
        + " AS source_asset_key",
        "lower(cast(asset_type as string)) AS asset_type",
        "cast(file_code as string) AS file_code",
        "cast(file_format as string) AS file_format",
        _i("cycle_start_year", "cycle_start_year"), _i("cycle_end_year", "cycle_end_year"),
        "cast(cycle_label as string) AS cycle_label",
        "cast(source_url as string) AS source_url",
        _i("mortality_public_release_year", "mortality_public_release_year"),
        "cast(mortality_followup_available_through as string) AS mortality_followup_available_through",
        "cast(paper_comparability_note as string) AS paper_comparability_note",
    ]


# staging view: (landing table, its projection)
STAGED = {
    "stg_demo": ("demo", demo_columns()),
    "stg_dr1tot": ("dr1tot", totals_columns(1)),
    "stg_dr2tot": ("dr2tot", totals_columns(2)),
    "stg_dr1iff": ("dr1iff", items_columns(1)),
    "stg_dr2iff": ("dr2iff", items_columns(2)),
    "stg_glu": ("glu", glucose_columns()),
    "stg_mortality": ("mortality", mortality_columns()),
    "stg_source_catalog": ("source_catalog", source_catalog_columns()),
}


def stg_mortality(mortality: DataFrame) -> DataFrame:
    return project(mortality, mortality_columns())


def view_text(name: str, source: str) -> str:
    """The statement behind a staging view over the table called ``source``."""
    return f"SELECT {', '.join(STAGED[name][1])} FROM {source}"


class Staged(Mapping):
    """The staging view of every landing table there is; a view lands its table when first used."""

    def __init__(self, landing: Mapping[str, DataFrame]) -> None:
        self.landing = landing
        self.views: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return (name for name, (source, _) in STAGED.items() if source in list(self.landing))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.views:
            source, columns = STAGED[name]
            self.views[name] = project(self.landing[source], columns)
        return self.views[name]


def staged(landing: Mapping[str, DataFrame]) -> Staged:
    return Staged(landing)
