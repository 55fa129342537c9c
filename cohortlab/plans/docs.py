"""Texts of tables and columns (SNK5): every column of every published table has one."""

from __future__ import annotations

import re
from collections.abc import Iterable

TABLES = {
    "keyed_demo": "Respondents of every cycle, stored by respondent",
    "keyed_dr1tot": "First-day intake totals, stored by respondent",
    "keyed_dr2tot": "Second-day intake totals, stored by respondent",
    "keyed_glu": "Fasting glucose and insulin, stored by respondent",
    "keyed_mortality": "Follow-up of deaths, stored by respondent",
    "respondent_daily": "One row per respondent: both days' totals, glucose and follow-up",
    "protein_items": "One row per reported food: its protein and whether it is animal or plant",
    "protein_source_estimates": "Per respondent: protein of both days by source",
    "validation_cohort": "Eligible respondents from 50 years on with first-day intake",
    "validation_summary_parts": "Counts, sums and numbers of values of the cohort per cycle, age band and protein group",
    "validation_summary": "The cohort by age band and protein group",
    "cycle_protein_trends": "Adults by cycle, age band and protein group",
    "flow_cohort": "The cohort as the orchestrator's own SQL selects it",
    "flow_summary": "The orchestrator's cohort by age band and protein group",
    "spoilt_cohort": "The cohort with a tenth of its age bands spoilt: its tests must fail",
}
_PLAIN = {
    "respondent_key": "respondent number and both years of the cycle, joined by bars",
    "respondent_id": "number of the respondent",
    "cycle_start_year": "first year of the cycle", "cycle_end_year": "last year of the cycle",
    "cycle_label": "first and last year of the cycle", "survey_cycle_code": "number of the cycle in the survey's own count",
    "age_years": "age at the interview in whole years", "sex_code": "sex as coded by the survey",
    "race_ethnicity_code": "race and ethnicity as coded by the survey", "education_code": "education of adults as coded by the survey",
    "poverty_income_ratio": "family income over the poverty line", "survey_psu": "masked sampling unit",
    "survey_strata": "masked stratum", "interview_weight_2yr": "weight of the interview for one cycle",
    "mec_weight_2yr": "weight of the examination for one cycle", "fasting_weight_2yr": "weight of the fasting sample for one cycle",
    "two_day_recall_weight_2yr": "weight of respondents with both recall days for one cycle",
    "recall_day_weight_2yr": "weight of the row's recall day for one cycle",
    "file_code": "code of the file that the row comes from", "source_url": "place of the file that the row comes from",
    "age_band_levine": "age band of the eligibility rule and the rates", "adult_age_band": "age band of adults in the trends",
    "mortality_eligible_flag": "whether the respondent is eligible for follow-up",
    "eligibility_status": "eligibility for follow-up as coded", "mortality_status": "1 if assumed dead, 0 if assumed alive",
    "died_during_followup": "whether the respondent died during follow-up",
    "underlying_cause_group_code": "leading cause of death, three digits",
    "diabetes_mentioned_flag": "1 if diabetes is among the causes", "hypertension_mentioned_flag": "1 if hypertension is among the causes",
    "cancer_death_flag": "whether cancer was the leading cause", "diabetes_mcod_flag": "whether diabetes is among the causes",
    "hypertension_mcod_flag": "whether hypertension is among the causes",
    "followup_months_interview": "months of follow-up from the interview", "followup_months_exam": "months of follow-up from the examination",
    "mortality_public_release_year": "year of the follow-up release", "fasting_glucose_category": "range of the fasting glucose, MISSING if unknown",
    "comparability_note": "how far the cohort can be compared", "protein_source_note": "how the protein sources were estimated",
    "protein_item_key": "respondent key, recall day and line of the food", "recall_day": "1 or 2", "food_line_number": "line of the food on its day",
    "food_code": "code of the food", "food_code_padded": "code of the food in eight digits", "food_code_major_group": "leading digit of the padded code",
    "intake_grams": "grams eaten", "energy_kcal": "energy in kcal", "protein_g": "protein in grams", "carb_g": "carbohydrate in grams",
    "fat_g": "fat in grams", "eating_occasion": "occasion as coded", "ate_at_home_response": "eaten at home, as coded",
    "major_group_label": "name of the food group", "protein_source_group": "animal, plant or unclassified",
    "classification_method": "how the source was decided", "classification_notes": "why the group has its source",
    "summary_key": "age band and protein group", "trend_key": "cycle, age band and protein group",
    "respondent_n": "number of respondents", "sample_n": "number of respondents", "weighted_population_2yr": "sum of weights",
    "weighted_population_day_1": "sum of pooled first-day weights", "weighted_population": "sum of pooled first-day weights",
    "seqn": "number of the respondent", "sddsrvyr": "number of the cycle in the survey's own count", "sdmvpsu": "masked sampling unit",
    "sdmvstra": "masked stratum", "paper_age_band": "age band from the age before rounding", "eligstat": "eligibility for follow-up as coded",
    "mortstat": "1 if assumed dead, 0 if assumed alive", "ucod_leading": "leading cause of death, three digits",
    "diabetes": "1 if diabetes is among the causes", "hyperten": "1 if hypertension is among the causes",
}
_STEMS = {
    "recall_weight_2yr": "recall weight for one cycle", "recall_weight_16yr": "recall weight pooled over eight cycles",
    "recall_status": "status of the recall as coded", "energy_kcal": "total energy in kcal", "protein_g": "total protein in grams",
    "carb_g": "total carbohydrate in grams", "fat_g": "total fat in grams", "item_protein_g": "protein summed over foods, in grams",
    "item_energy_kcal": "energy summed over foods, in kcal", "animal_protein_g_est": "protein of animal foods, in grams",
    "plant_protein_g_est": "protein of plant foods, in grams", "unclassified_protein_g": "protein of other foods, in grams",
    "animal_protein_share_est": "share of protein from animal foods", "plant_protein_share_est": "share of protein from plant foods",
    "unclassified_protein_share": "share of protein from other foods", "animal_item_count": "number of animal foods",
    "plant_item_count": "number of plant foods", "unclassified_item_count": "number of other foods",
    "animal_protein_pct_kcal_est": "share of energy from animal protein", "plant_protein_pct_kcal_est": "share of energy from plant protein",
}
_PATTERNS = [
    (r"day_([12])_(\w+)", lambda m: _STEMS.get(m[2]) and f"day {m[1]}: {_STEMS[m[2]]}"),
    (r"avg_(\w+)", lambda m: f"mean: {column_text(m[1]) or m[1].replace('_', ' ')}"),
    (r"sum_(\w+)", lambda m: f"sum: {column_text(m[1])}"),
    (r"n_(\w+)", lambda m: f"number of values: {column_text(m[1])}"),
    (r"protein_group_day_?1", lambda m: "band of the share of energy from protein on day 1"),
    (r"protein_pct_kcal_day_?1", lambda m: "share of energy from protein on day 1"),
    (r"protein_pct_kcal_mean_2day", lambda m: "share of energy from protein over both days"),
    (r"(mec|fasting)_weight_16yr", lambda m: f"{'examination' if m[1] == 'mec' else 'fasting'} weight pooled over eight cycles"),
    (r"fasting_(\w+?)_(mg_dl|mmol_l|uuml|pmol_l)", lambda m: f"fasting {m[1]} ({m[2].replace('_', '/')})"),
    (r"fasting_(hours|minutes)", lambda m: f"{m[1]} since the last meal"),
    (r"weighted_(\w+?)_(deaths|mentions)", lambda m: f"sum of weights of {m[1].replace('_', ' ')} {m[2]}"),
    (r"wt(\w+?)_?(16yr|2yr)?", lambda m: f"weight ({m[1]}) {'pooled over eight cycles' if m[2] == '16yr' else 'for one cycle'}"),
    (r"dr([12])t(\w+)", lambda m: f"day {m[1]}: total as the survey names it ({m[2]})"),
    (r"(lbxglu|lbdglusi)", lambda m: "fasting glucose in " + ("mg/dl" if m[1] == "lbxglu" else "mmol/l")),
    (r"phafst(hr|mn)", lambda m: f"{'hours' if m[1] == 'hr' else 'minutes'} since the last meal"),
    (r"permth_(int|exm)", lambda m: f"months of follow-up from the {'interview' if m[1] == 'int' else 'examination'}"),
    (r"followup_months_from_(interview|exam)", lambda m: f"months of follow-up from the {m[1]}"),
]


def column_text(name: str) -> str | None:
    """The text of a column, from its name; None for a name without one."""
    low = name.lower()
    if low in _PLAIN:
        return _PLAIN[low]
    for pattern, text in _PATTERNS:
        if (m := re.fullmatch(pattern, low)) and (found := text(m)):
            return found
    return None


def column_texts(columns: Iterable[str]) -> dict[str, str]:
    """Texts of all ``columns``; a column without one is an error."""
    out = {c: column_text(c) for c in columns}
    if missing := [c for c, text in out.items() if not text]:
        raise KeyError(f"columns without a text: {missing}")
    return out
