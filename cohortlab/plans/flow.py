"""Orchestrator-flow variants M9 (cohort) and M10 (summary) on raw landing names.

Differences from M4/M5: raw float age is banded without rounding (ages in
(65, 66) get a NULL band), raw upper-case column names are kept, the cycle
start year is restricted to 2003-2017, weights are not NULL-coalesced in the
summary, and there are no item-source columns. The four left joins share the
3-column key, so the demo side is exchanged once; the ``ELIGSTAT = 1`` and
not-NULL filters make the mortality and day-1 joins inner. They are merge joins
by hint: a landed table's packed files say little about its decoded size, and
one that passed for small would be broadcast through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlab.functions import bands as B
from cohortlab.functions.sql import aggregate, select_list
from cohortlab.operators.aggregates import mean, weighted_conditional
from cohortlab.plans import notes

RAW_KEY = ["SEQN", "CYCLE_START_YEAR", "CYCLE_END_YEAR"]
POOLED_CYCLES = 8.0


def flow_cohort(landing: dict[str, DataFrame], note: str = notes.FLOW_NOTE) -> DataFrame:
    """M9: eligible respondents aged 50+ (raw age) from cycles starting 2003-2017."""
    share = B.protein_energy_share("DR1TPROT", "DR1TKCAL")
    cols = [
        "d.SEQN", "d.CYCLE_START_YEAR", "d.CYCLE_END_YEAR", "d.CYCLE_LABEL", "d.SDDSRVYR",
        "d.RIDAGEYR AS AGE_YEARS", "d.RIAGENDR AS SEX_CODE", "d.RIDRETH1 AS RACE_ETHNICITY_CODE",
        "d.DMDEDUC2 AS EDUCATION_CODE", "d.INDFMPIR AS POVERTY_INCOME_RATIO", "d.SDMVPSU", "d.SDMVSTRA",
        "d.WTINT2YR", "d.WTMEC2YR", "t1.WTDRD1", "t2.WTDR2D",
        "t1.DR1TKCAL", "t1.DR1TPROT", "t1.DR1TCARB", "t1.DR1TTFAT",
        "t2.DR2TKCAL", "t2.DR2TPROT", "t2.DR2TCARB", "t2.DR2TTFAT",
        "g.WTSAF2YR", "g.LBXGLU", "g.LBDGLUSI", "g.PHAFSTHR", "g.PHAFSTMN",
        "m.ELIGSTAT", "m.MORTSTAT", "m.UCOD_LEADING", "m.DIABETES", "m.HYPERTEN", "m.PERMTH_INT",
        "m.PERMTH_EXM", "m.MORTALITY_PUBLIC_RELEASE_YEAR",
        f"{share} AS PROTEIN_PCT_KCAL_DAY1",
        f"{B.protein_group(share)} AS PROTEIN_GROUP_DAY1",
        f"{B.two_day_mean_share('DR1TPROT', 'DR1TKCAL', 'DR2TPROT', 'DR2TKCAL')} AS PROTEIN_PCT_KCAL_MEAN_2DAY",
        f"{B.paper_age_band('d.RIDAGEYR')} AS PAPER_AGE_BAND",
        f"{B.rescale_weight('d.WTMEC2YR', POOLED_CYCLES)} AS WTMEC16YR",
        f"{B.rescale_weight('t1.WTDRD1', POOLED_CYCLES)} AS WTDRD1_16YR",
        f"{B.rescale_weight('t2.WTDR2D', POOLED_CYCLES)} AS WTDR2D_16YR",
        f"{B.rescale_weight('g.WTSAF2YR', POOLED_CYCLES)} AS WTSAF16YR",
        f"{B.equals_flag('m.MORTSTAT', 1)} AS DIED_DURING_FOLLOWUP",
        f"{B.equals_flag('m.UCOD_LEADING', '002')} AS CANCER_DEATH_FLAG",
        f"{B.equals_flag('m.DIABETES', 1)} AS DIABETES_MCOD_FLAG",
        f"{B.glucose_category('g.LBXGLU')} AS FASTING_GLUCOSE_CATEGORY",
        f"{B.lit(note)} AS COMPARABILITY_NOTE",
    ]
    using = ", ".join(RAW_KEY)
    text = (f"SELECT /*+ MERGE(t1, t2, g, m) */\n  {select_list(cols)}\nFROM {{d}} d\n"
            f"LEFT JOIN {{t1}} t1 USING ({using})\nLEFT JOIN {{t2}} t2 USING ({using})\n"
            f"LEFT JOIN {{g}} g USING ({using})\nLEFT JOIN {{m}} m USING ({using})\n"
            "WHERE d.CYCLE_START_YEAR BETWEEN 2003 AND 2017 AND d.RIDAGEYR >= 50\n"
            "  AND m.ELIGSTAT = 1 AND t1.DR1TKCAL IS NOT NULL AND t1.DR1TPROT IS NOT NULL")
    demo = landing["demo"]
    return demo.sparkSession.sql(text, d=demo, t1=landing["dr1tot"], t2=landing["dr2tot"],
                                 g=landing["glu"], m=landing["mortality"])


def flow_summary(cohort: DataFrame) -> DataFrame:
    """M10: counts, weighted totals (NULL weights skipped) and follow-up means."""
    w = "WTDRD1_16YR"
    return aggregate(cohort, ["PAPER_AGE_BAND", "PROTEIN_GROUP_DAY1"], [
        "count(1) AS SAMPLE_N",
        f"sum({w}) AS WEIGHTED_POPULATION",
        f"{weighted_conditional('DIED_DURING_FOLLOWUP', w, null_weight_as_zero=False)} AS WEIGHTED_ALL_CAUSE_DEATHS",
        f"{weighted_conditional('CANCER_DEATH_FLAG', w, null_weight_as_zero=False)} AS WEIGHTED_CANCER_DEATHS",
        f"{mean('PERMTH_INT')} AS AVG_FOLLOWUP_MONTHS_FROM_INTERVIEW",
        f"{mean('PERMTH_EXM')} AS AVG_FOLLOWUP_MONTHS_FROM_EXAM",
    ])
