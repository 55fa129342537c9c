"""Dashboard report queries M7 and M8.

Both reports aggregate the cohort mart to at most a few dozen rows first and
reshape only the aggregate; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlab.functions import bands as B
from cohortlab.functions.sql import aggregate, project, q
from cohortlab.operators.aggregates import weighted_rate
from cohortlab.operators.reshape import melt, order_by_category, relabel, title_label

# Display relabels, cause names, CVD cause codes, intake order.
AGE_DISPLAY = {"50_65": "50-65", "66_PLUS": "66+"}
CAUSES = ["All-Cause Mortality", "Cancer", "Diabetes", "CVD"]
CVD_CAUSE_CODES = ["001", "005"]
INTAKE_ORDER = ["LOW", "MODERATE", "HIGH"]
WEIGHT = "day_1_recall_weight_16yr"


def mortality_rates_wide(cohort: DataFrame) -> DataFrame:
    """Four weighted death rates per 1,000 by age band and protein group."""
    codes = ", ".join(B.lit(c) for c in CVD_CAUSE_CODES)
    flags = ["died_during_followup", "cancer_death_flag", "diabetes_mcod_flag",
             f"underlying_cause_group_code IN ({codes})"]
    return aggregate(
        cohort, ["age_band_levine AS age_group", "protein_group_day_1 AS protein_intake"],
        [f"{weighted_rate(f, WEIGHT)} AS {q(n)}" for f, n in zip(flags, CAUSES)],
        where="age_band_levine IS NOT NULL AND protein_group_day_1 IS NOT NULL")


def mortality_rates_long(cohort: DataFrame) -> DataFrame:
    """M7: long form (age group, intake, cause, rate), display labels, intake ordinal."""
    wide = mortality_rates_wide(cohort)
    long = relabel(melt(wide, ["age_group", "protein_intake"], CAUSES, "cause", "rate_per_1000"),
                   "age_group", AGE_DISPLAY)
    return order_by_category(long, "protein_intake", INTAKE_ORDER, ordinal_name="protein_intake_order")


RATE_COLUMNS = ["cancer_rate", "diabetes_rate", "hypertension_rate", "mortality_rate"]


def source_rates_wide(cohort: DataFrame) -> DataFrame:
    """Rates by age band and animal / plant protein bin, one pass over the cohort.

    The reference unions two aggregates (animal bins, plant bins). Here each
    cohort row emits one (type, grams, bin) pair per protein type with
    ``inline`` and a single ``GROUP BY`` covers both; the result is identical
    row for row, with one scan of the cohort and one shuffle.
    """
    animal, plant = "day_1_animal_protein_g_est", "day_1_plant_protein_g_est"
    pairs = (f"inline(array("
             f"struct('Animal Protein' AS protein_type, cast({animal} as double) AS grams, "
             f"{B.animal_protein_bins(animal)} AS protein_quartile), "
             f"struct('Plant Protein' AS protein_type, cast({plant} as double) AS grams, "
             f"{B.plant_protein_bins(plant)} AS protein_quartile)))")
    exploded = project(cohort, ["age_band_levine", "died_during_followup", "cancer_death_flag",
                                "diabetes_mcod_flag", "hypertension_mcod_flag", WEIGHT, pairs],
                       where="age_band_levine IS NOT NULL")
    flags = ["cancer_death_flag", "diabetes_mcod_flag", "hypertension_mcod_flag", "died_during_followup"]
    return aggregate(exploded, ["age_band_levine", "protein_type", "protein_quartile"],
                     [f"{weighted_rate(f, WEIGHT)} AS {n}" for f, n in zip(flags, RATE_COLUMNS)],
                     where="grams IS NOT NULL")


def source_rates_long(cohort: DataFrame) -> DataFrame:
    """M8: melted rates with display labels (``cancer_rate -> Cancer``)."""
    wide = source_rates_wide(cohort)
    long = melt(wide, ["age_band_levine", "protein_type", "protein_quartile"], RATE_COLUMNS,
                "disease", "rate_per_1000")
    long = relabel(long, "age_band_levine", AGE_DISPLAY)
    return project(long, ["age_band_levine", "protein_type", "protein_quartile",
                          f"{title_label('disease')} AS disease", "rate_per_1000"])


def protein_type_rates(rates: DataFrame, protein_type: str) -> DataFrame:
    """FLT8: the M8 rows of one protein type."""
    return rates.filter(f"protein_type = {B.lit(protein_type)}")
