"""Composed models M1-M6 (the dbt DAG) over staged tables.

DAG: M1 <- demo, day totals, glucose, mortality; M2 <- day-1/day-2 items +
group map; M3 <- M2; M4 <- M1, M3; M5 <- M4; M6 <- M1, M3.

Partitioning: every respondent-level input joins on ``respondent_key``. The
demo side is exchanged once and the four left joins reuse that hash
partitioning. M4 and M6 read no descriptive column of M3, so they join the item
sums grouped by ``respondent_key`` alone, whose output is already partitioned for
that join; M3's own output keeps its five grouping columns. Null-rejecting filters in M4/M6 turn the outer
joins they touch into inner joins.

Each model is one SQL statement over its input DataFrames, so building the
DAG costs a few driver-to-JVM calls per model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions import bands as B
from cohortlab.functions.sql import aggregate, project, select_list
from cohortlab.operators.aggregates import mean, weighted_conditional, weighted_total
from cohortlab.operators.joins import lookup_join
from cohortlab.operators.reshape import union_all_by_name
from cohortlab.plans import notes
from cohortlab.sinks.warehouse import star_join
from cohortlab.sources import seeds

KEY = "respondent_key"

POOLED_CYCLES = 8.0

DEMO_COLS = ["respondent_id", "cycle_start_year", "cycle_end_year", "cycle_label", "survey_cycle_code",
             "age_years", "sex_code", "race_ethnicity_code", "education_code", "poverty_income_ratio",
             "survey_psu", "survey_strata", "interview_weight_2yr", "mec_weight_2yr"]
GLU_COLS = ["fasting_weight_2yr", "fasting_glucose_mg_dl", "fasting_glucose_mmol_l", "fasting_hours",
            "fasting_minutes", "fasting_insulin_uuml", "fasting_insulin_pmol_l"]
MORT_COLS = ["eligibility_status", "mortality_status", "underlying_cause_group_code",
             "diabetes_mentioned_flag", "hypertension_mentioned_flag", "followup_months_interview",
             "followup_months_exam", "mortality_public_release_year"]


def _tot_cols(day: int) -> list[str]:
    return [f"day_{day}_{c}" for c in ("recall_weight_2yr", "recall_status", "energy_kcal", "protein_g",
                                       "carb_g", "fat_g")]


def _left_joins(fact: DataFrame, dims: dict[str, DataFrame], columns: Sequence[str], where: str = "",
                stored: bool = False, keyless: bool = True) -> DataFrame:
    """``fact`` (alias d) left joined to ``dims`` (alias -> table) by respondent.

    ``stored``: all are tables of one warehouse, stored by respondent, and meet
    without an exchange; ``keyless``: ``fact`` has rows without a key, which bypass the joins.
    """
    if stored:
        return star_join(fact, list(dims.values()), KEY, columns, "d", list(dims), where, keyless)
    joins = "".join(f"\nLEFT JOIN {{{n}}} {n} USING ({KEY})" for n in dims)
    text = f"SELECT\n  {select_list(columns)}\nFROM {{d}} d{joins}" + (f"\nWHERE {where}" if where else "")
    return fact.sparkSession.sql(text, d=fact, **dims)


def respondent_daily(stg: Mapping[str, DataFrame], stored: bool = False, keyless: bool = True) -> DataFrame:
    """M1: one row per respondent with day totals, glucose and mortality."""
    cols = [
        f"d.{KEY}", *[f"d.{c}" for c in DEMO_COLS],
        "t1.day_1_recall_weight_2yr", "t2.day_2_recall_weight_2yr",
        "t1.day_1_recall_status", "t2.day_2_recall_status",
        *[f"t1.day_1_{c}" for c in ("energy_kcal", "protein_g", "carb_g", "fat_g")],
        *[f"t2.day_2_{c}" for c in ("energy_kcal", "protein_g", "carb_g", "fat_g")],
        *[f"g.{c}" for c in GLU_COLS],
        "m.eligibility_status",
        f"{B.equals_flag('m.eligibility_status', 1)} AS mortality_eligible_flag",
        "m.mortality_status",
        f"{B.equals_flag('m.mortality_status', 1)} AS died_during_followup",
        *[f"m.{c}" for c in MORT_COLS[2:]],
        f"{B.age_band_levine('d.age_years')} AS age_band_levine",
        f"{B.adult_age_band('d.age_years')} AS adult_age_band",
    ]
    dims = {"t1": stg["stg_dr1tot"], "t2": stg["stg_dr2tot"], "g": stg["stg_glu"], "m": stg["stg_mortality"]}
    return _left_joins(stg["stg_demo"], dims, cols, stored=stored, keyless=keyless)


ITEM_COLUMNS = [
    "protein_item_key", KEY, "respondent_id", "cycle_start_year", "cycle_end_year", "cycle_label",
    "recall_day", "food_line_number", "food_code", "food_code_padded", "food_code_major_group",
    "recall_day_weight_2yr", "intake_grams", "energy_kcal", "protein_g", "carb_g", "fat_g",
    "eating_occasion", "ate_at_home_response",
]


def protein_items(stg: dict[str, DataFrame], group_map: DataFrame) -> DataFrame:
    """M2: day-1 and day-2 items in long form, classified by food major group.

    The 9-row map is broadcast (bounded by construction). Items with NULL
    protein are dropped after classification; the filter commutes with the
    left join, so Catalyst pushes it below the join and the union.
    """
    days = []
    for d in (1, 2):
        cols = [f"{d} AS recall_day" if c == "recall_day" else
                f"day_{d}_recall_weight_2yr AS recall_day_weight_2yr" if c == "recall_day_weight_2yr" else c
                for c in ITEM_COLUMNS]
        days.append(project(stg[f"stg_dr{d}iff"], cols))
    unioned = union_all_by_name(days)
    gm = project(group_map, ["food_code_major_group", *seeds.UNMAPPED_DEFAULTS])
    classified = lookup_join(unioned, gm, "food_code_major_group", seeds.UNMAPPED_DEFAULTS,
                             dim_row_bound=seeds.GROUP_MAP_MAX_ROWS)
    return project(classified, [*ITEM_COLUMNS, *seeds.UNMAPPED_DEFAULTS], where="protein_g IS NOT NULL")


SOURCE_GROUPS = ("animal", "plant", "unclassified")


DESCRIPTIVE = ("respondent_id", "cycle_start_year", "cycle_end_year", "cycle_label")


def protein_source_estimates(items: DataFrame, descriptive: Sequence[str] = DESCRIPTIVE) -> DataFrame:
    """M3: per respondent, day-1 and day-2 item totals by protein source.

    The reference aggregates per (respondent, day) and then pivots the two
    days with ``max(case when day = d ...)``. Because the day is a grouping key
    of the first level, both levels fold into one conditional aggregate per
    respondent: one exchange, with a map-side partial aggregate that collapses
    a respondent's items (and any hot key) before the shuffle. A day with no
    items yields NULL totals and NULL counts, exactly as the two-level form.

    The respondent's descriptive columns are grouping keys (as in the
    reference) rather than ``max()`` aggregates: a string aggregate buffer
    would force a sort-based aggregate over every item row. With no
    ``descriptive`` columns the result is keyed, and partitioned, by respondent.
    """
    aggs = []
    for d in (1, 2):
        on = f"recall_day = {d}"
        aggs += [
            f"sum(CASE WHEN {on} THEN protein_g END) AS day_{d}_item_protein_g",
            f"sum(CASE WHEN {on} THEN energy_kcal END) AS day_{d}_item_energy_kcal",
        ]
        for g, name in (("animal", "animal_protein_g_est"), ("plant", "plant_protein_g_est"),
                        ("unclassified", "unclassified_protein_g")):
            aggs.append(f"sum(CASE WHEN {on} THEN (CASE WHEN protein_source_group = '{g}' THEN protein_g "
                        f"ELSE 0 END) END) AS day_{d}_{name}")
        for g in SOURCE_GROUPS:
            aggs.append(f"cast(sum(CASE WHEN {on} THEN (CASE WHEN protein_source_group = '{g}' THEN 1 "
                        f"ELSE 0 END) END) as bigint) AS day_{d}_{g}_item_count")
    agg = aggregate(items, [KEY, *descriptive], aggs)
    out = [KEY, *descriptive]
    for d in (1, 2):
        total = f"day_{d}_item_protein_g"
        out += [
            total, f"day_{d}_item_energy_kcal", f"day_{d}_animal_protein_g_est",
            f"day_{d}_plant_protein_g_est", f"day_{d}_unclassified_protein_g",
            f"{B.safe_ratio(f'day_{d}_animal_protein_g_est', total)} AS day_{d}_animal_protein_share_est",
            f"{B.safe_ratio(f'day_{d}_plant_protein_g_est', total)} AS day_{d}_plant_protein_share_est",
            f"{B.safe_ratio(f'day_{d}_unclassified_protein_g', total)} AS day_{d}_unclassified_protein_share",
            f"day_{d}_animal_item_count", f"day_{d}_plant_item_count", f"day_{d}_unclassified_item_count",
        ]
    return project(agg, out)


SOURCE_STEMS = ["item_protein_g", "item_energy_kcal", "animal_protein_g_est", "plant_protein_g_est",
                "unclassified_protein_g", "animal_protein_share_est", "plant_protein_share_est",
                "unclassified_protein_share"]
SOURCE_COLUMNS = [f"day_{d}_{c}" for d in (1, 2) for c in SOURCE_STEMS]


def validation_cohort(daily: DataFrame, sources: DataFrame, comparability_note: str = notes.COHORT_NOTE,
                      source_note: str = notes.SOURCE_NOTE, stored: bool = False, keyless: bool = True) -> DataFrame:
    """M4: mortality-eligible respondents aged 50+ with day-1 intake.

    The eligibility flag and the not-NULL filters reject NULLs from the
    mortality and day-1 joins, so Catalyst plans those as inner joins.
    """
    share1 = B.protein_energy_share("day_1_protein_g", "day_1_energy_kcal")
    cols = [
        f"d.{KEY}", "respondent_id", "cycle_start_year", "cycle_end_year", "cycle_label",
        "survey_cycle_code", "age_years", "age_band_levine", "sex_code", "race_ethnicity_code",
        "education_code", "poverty_income_ratio", "survey_psu", "survey_strata",
        "interview_weight_2yr", "mec_weight_2yr", "day_1_recall_weight_2yr",
        "day_2_recall_weight_2yr", "fasting_weight_2yr",
        f"{B.rescale_weight('mec_weight_2yr', POOLED_CYCLES)} AS mec_weight_16yr",
        f"{B.rescale_weight('day_1_recall_weight_2yr', POOLED_CYCLES)} AS day_1_recall_weight_16yr",
        f"{B.rescale_weight('day_2_recall_weight_2yr', POOLED_CYCLES)} AS day_2_recall_weight_16yr",
        f"{B.rescale_weight('fasting_weight_2yr', POOLED_CYCLES)} AS fasting_weight_16yr",
        "day_1_energy_kcal", "day_1_protein_g", "day_1_carb_g", "day_1_fat_g",
        f"{share1} AS protein_pct_kcal_day_1",
        f"{B.protein_group(share1)} AS protein_group_day_1",
        "day_2_energy_kcal", "day_2_protein_g", "day_2_carb_g", "day_2_fat_g",
        f"{B.two_day_mean_share('day_1_protein_g', 'day_1_energy_kcal', 'day_2_protein_g', 'day_2_energy_kcal')}"
        " AS protein_pct_kcal_mean_2day",
        *[f"day_1_{c}" for c in SOURCE_STEMS],
        f"{B.protein_energy_share('day_1_animal_protein_g_est', 'day_1_energy_kcal')}"
        " AS day_1_animal_protein_pct_kcal_est",
        f"{B.protein_energy_share('day_1_plant_protein_g_est', 'day_1_energy_kcal')}"
        " AS day_1_plant_protein_pct_kcal_est",
        *[f"day_2_{c}" for c in SOURCE_STEMS],
        "fasting_glucose_mg_dl", "fasting_glucose_mmol_l", "fasting_insulin_uuml",
        "fasting_insulin_pmol_l", "fasting_hours", "fasting_minutes",
        f"{B.glucose_category('fasting_glucose_mg_dl')} AS fasting_glucose_category",
        "mortality_status", "died_during_followup",
        f"{B.equals_flag('underlying_cause_group_code', '002')} AS cancer_death_flag",
        f"{B.equals_flag('diabetes_mentioned_flag', 1)} AS diabetes_mcod_flag",
        f"{B.equals_flag('hypertension_mentioned_flag', 1)} AS hypertension_mcod_flag",
        "underlying_cause_group_code", "followup_months_interview", "followup_months_exam",
        "mortality_public_release_year",
        f"{B.lit(comparability_note)} AS comparability_note",
        f"{B.lit(source_note)} AS protein_source_note",
    ]
    return _left_joins(daily, {"p": project(sources, [KEY, *SOURCE_COLUMNS])}, cols,
                       "mortality_eligible_flag AND age_years >= 50\n"
                       "  AND day_1_energy_kcal IS NOT NULL AND day_1_protein_g IS NOT NULL", stored, keyless)


def validation_summary(cohort: DataFrame) -> DataFrame:
    """M5: cohort aggregated by age band and protein group (NULL weights as 0)."""
    w = "day_1_recall_weight_16yr"
    return aggregate(
        cohort,
        ["concat(age_band_levine, '|', protein_group_day_1) AS summary_key", "age_band_levine",
         "protein_group_day_1"],
        [
            "count(1) AS respondent_n",
            f"{weighted_total(w)} AS weighted_population_day_1",
            f"{weighted_conditional('died_during_followup', w)} AS weighted_all_cause_deaths",
            f"{weighted_conditional('cancer_death_flag', w)} AS weighted_cancer_deaths",
            f"{weighted_conditional('diabetes_mcod_flag', w)} AS weighted_diabetes_mentions",
            f"{mean('protein_pct_kcal_day_1')} AS avg_protein_pct_kcal_day_1",
            f"{mean('protein_pct_kcal_mean_2day')} AS avg_protein_pct_kcal_mean_2day",
            f"{mean('day_1_animal_protein_share_est')} AS avg_day_1_animal_protein_share_est",
            f"{mean('day_1_plant_protein_share_est')} AS avg_day_1_plant_protein_share_est",
            f"{mean('fasting_glucose_mg_dl')} AS avg_fasting_glucose_mg_dl",
            f"{mean('followup_months_interview')} AS avg_followup_months_interview",
            f"{mean('followup_months_exam')} AS avg_followup_months_exam",
        ])


ADULT_BANDS = ["18_49", "50_65", "66_PLUS"]


SUMMARY_KEYS = ("age_band_levine", "protein_group_day_1")
SUMMARY_SUMS = {
    "weighted_population_day_1": None, "weighted_all_cause_deaths": "died_during_followup",
    "weighted_cancer_deaths": "cancer_death_flag", "weighted_diabetes_mentions": "diabetes_mcod_flag"}
SUMMARY_MEANS = ("protein_pct_kcal_day_1", "protein_pct_kcal_mean_2day", "day_1_animal_protein_share_est",
                 "day_1_plant_protein_share_est", "fasting_glucose_mg_dl", "followup_months_interview",
                 "followup_months_exam")


def summary_parts(cohort: DataFrame) -> DataFrame:
    """What M5 needs of each cycle: row counts, weighted sums, and sum and count of every mean."""
    w = "day_1_recall_weight_16yr"
    aggs = ["count(1) AS respondent_n"]
    aggs += [f"{weighted_total(w) if flag is None else weighted_conditional(flag, w)} AS {n}" for n, flag in SUMMARY_SUMS.items()]
    for c in SUMMARY_MEANS:
        aggs += [f"sum(cast({c} as double)) AS sum_{c}", f"count({c}) AS n_{c}"]
    return aggregate(cohort, ["cycle_start_year", *SUMMARY_KEYS], aggs)


def merged_summary(parts: DataFrame) -> DataFrame:
    """M5 from its per-cycle parts: the same rows as :func:`validation_summary` of the whole cohort."""
    return aggregate(parts, [f"concat({SUMMARY_KEYS[0]}, '|', {SUMMARY_KEYS[1]}) AS summary_key", *SUMMARY_KEYS], [
        "sum(respondent_n) AS respondent_n", *[f"sum({n}) AS {n}" for n in SUMMARY_SUMS],
        *[f"{B.safe_ratio(f'sum(sum_{c})', f'sum(n_{c})')} AS avg_{c}" for c in SUMMARY_MEANS]])


def cycle_protein_trends(daily: DataFrame, sources: DataFrame, stored: bool = False, keyless: bool = True) -> DataFrame:
    """M6: adults per cycle, age band and day-1 protein group."""
    share1 = B.protein_energy_share("day_1_protein_g", "day_1_energy_kcal")
    scored_cols = [
        "cycle_start_year", "cycle_end_year", "cycle_label", "adult_age_band",
        "day_1_recall_weight_2yr", "day_1_energy_kcal", "day_1_protein_g",
        f"{share1} AS protein_pct_kcal_day_1", f"{B.protein_group(share1)} AS protein_group_day_1",
        "fasting_glucose_mg_dl", "day_1_animal_protein_share_est", "day_1_plant_protein_share_est",
    ]
    bands = ", ".join(B.lit(b) for b in ADULT_BANDS)
    shares = project(sources, [KEY, "day_1_animal_protein_share_est", "day_1_plant_protein_share_est"])
    scored = _left_joins(daily, {"p": shares}, scored_cols,
                         "age_years >= 18 AND day_1_energy_kcal IS NOT NULL AND day_1_protein_g IS NOT NULL\n"
                         f"  AND adult_age_band IN ({bands})", stored, keyless)
    return aggregate(
        scored,
        ["concat(cycle_label, '|', adult_age_band, '|', protein_group_day_1) AS trend_key",
         "cycle_start_year", "cycle_end_year", "cycle_label", "adult_age_band", "protein_group_day_1"],
        [
            "count(1) AS respondent_n",
            f"{weighted_total('day_1_recall_weight_2yr')} AS weighted_population_2yr",
            f"{mean('day_1_energy_kcal')} AS avg_day_1_energy_kcal",
            f"{mean('day_1_protein_g')} AS avg_day_1_protein_g",
            f"{mean('protein_pct_kcal_day_1')} AS avg_protein_pct_kcal_day_1",
            f"{mean('day_1_animal_protein_share_est')} AS avg_day_1_animal_protein_share_est",
            f"{mean('day_1_plant_protein_share_est')} AS avg_day_1_plant_protein_share_est",
            f"{mean('fasting_glucose_mg_dl')} AS avg_fasting_glucose_mg_dl",
        ])


def build_all(spark: SparkSession, stg: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The whole DAG over staging views, lazily; :mod:`cohortlab.plans.marts` stores it."""
    daily, items = respondent_daily(stg), protein_items(stg, seeds.group_map(spark))
    keyed = protein_source_estimates(items, ())  # the sums keyed, and partitioned, by respondent
    cohort = validation_cohort(daily, keyed)
    return {
        "respondent_daily": daily,
        "protein_items": items,
        "protein_source_estimates": protein_source_estimates(items),
        "validation_cohort": cohort,
        "validation_summary": validation_summary(cohort),
        "cycle_protein_trends": cycle_protein_trends(daily, keyed),
    }
