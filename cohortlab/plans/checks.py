"""The models' data tests: 39 generic column tests and 2 reconciliations.

``model_checks`` lists them per model; ``quality_report`` runs them all as
one DataFrame (see :mod:`cohortlab.operators.quality`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortlab.operators.quality import (
    KeyTest, TableChecks, counted_report, quality_report, reconcile_failures, reconcile_report, report_of, table_report,
    unique_report,
)
from cohortlab.sinks.warehouse import Warehouse

# Accepted values of the tested columns.
LEVINE_BANDS = ["UNDER_50", "50_65", "66_PLUS"]
COHORT_BANDS = ["50_65", "66_PLUS"]
ADULT_BANDS = ["18_49", "50_65", "66_PLUS"]
PROTEIN_GROUPS = ["LOW", "MODERATE", "HIGH"]
SOURCE_GROUPS = ["animal", "plant", "unclassified"]
RECONCILE_TOLERANCE_G = "0.1"


def model_checks(stg: dict[str, DataFrame], models: dict[str, DataFrame],
                 group_map: DataFrame) -> list[TableChecks]:
    k = "respondent_key"
    out = []
    if "stg_source_catalog" in stg:
        out.append(TableChecks("stg_source_catalog", stg["stg_source_catalog"],
                               not_null=["source_asset_key"], unique=["source_asset_key"]))
    out += [
        TableChecks("stg_demo", stg["stg_demo"], not_null=[k, "respondent_id", "cycle_label"], unique=[k]),
        TableChecks("stg_dr1tot", stg["stg_dr1tot"], not_null=[k], unique=[k]),
        TableChecks("stg_dr2tot", stg["stg_dr2tot"], not_null=[k], unique=[k]),
        TableChecks("stg_dr1iff", stg["stg_dr1iff"], not_null=["protein_item_key"], unique=["protein_item_key"]),
        TableChecks("stg_dr2iff", stg["stg_dr2iff"], not_null=["protein_item_key"], unique=["protein_item_key"]),
        TableChecks("stg_glu", stg["stg_glu"], not_null=[k], unique=[k]),
        TableChecks("stg_mortality", stg["stg_mortality"], not_null=[k], unique=[k]),
        TableChecks("respondent_daily", models["respondent_daily"], not_null=[k], unique=[k],
                    accepted={"age_band_levine": LEVINE_BANDS}),
        TableChecks("protein_items", models["protein_items"], not_null=["protein_item_key"],
                    unique=["protein_item_key"], accepted={"protein_source_group": SOURCE_GROUPS}),
        TableChecks("protein_source_estimates", models["protein_source_estimates"], not_null=[k], unique=[k]),
        TableChecks("validation_cohort", models["validation_cohort"], not_null=[k], unique=[k],
                    accepted={"age_band_levine": COHORT_BANDS, "protein_group_day_1": PROTEIN_GROUPS}),
        TableChecks("validation_summary", models["validation_summary"], not_null=["summary_key"],
                    unique=["summary_key"]),
        TableChecks("cycle_protein_trends", models["cycle_protein_trends"], not_null=["trend_key"],
                    unique=["trend_key"], accepted={"adult_age_band": ADULT_BANDS,
                                                    "protein_group_day_1": PROTEIN_GROUPS}),
        TableChecks("food_code_major_group_map", group_map, not_null=["food_code_major_group"],
                    unique=["food_code_major_group"], accepted={"protein_source_group": SOURCE_GROUPS}),
    ]
    return out


_K = "respondent_key"
# What the writes of stored tables count: table -> (columns that may not be NULL, accepted values).
COUNTED: dict[str, tuple[tuple[str, ...], dict[str, list]]] = {
    "keyed_demo": ((_K, "respondent_id", "cycle_label"), {}),
    "keyed_dr1tot": ((_K,), {}), "keyed_dr2tot": ((_K,), {}), "keyed_glu": ((_K,), {}), "keyed_mortality": ((_K,), {}),
    "respondent_daily": ((_K,), {"age_band_levine": LEVINE_BANDS}),
    "protein_items": (("protein_item_key",), {"protein_source_group": SOURCE_GROUPS}),
    "protein_source_estimates": ((_K,), {}),
    "validation_cohort": ((_K,), {"age_band_levine": COHORT_BANDS, "protein_group_day_1": PROTEIN_GROUPS}),
    "validation_summary": (("summary_key",), {}),
    "cycle_protein_trends": (("trend_key",), {"adult_age_band": ADULT_BANDS, "protein_group_day_1": PROTEIN_GROUPS}),
    "spoilt_cohort": ((_K,), {"age_band_levine": COHORT_BANDS}),
}
# Stored tables under the names of the models that they hold.
SHOWN_AS = {"keyed_demo": "stg_demo", "keyed_dr1tot": "stg_dr1tot", "keyed_dr2tot": "stg_dr2tot",
            "keyed_glu": "stg_glu", "keyed_mortality": "stg_mortality"}


def stored_report(wh: Warehouse, others: Sequence[TableChecks], comparisons: Sequence[tuple[str, str, str, str]],
                  daily: DataFrame) -> DataFrame:
    """The tests of all stored tables: counts from their writes, uniqueness read once.

    ``others`` are tables without counts, tested by reading; ``comparisons`` the
    reconciliations of ``daily`` with the item estimates, all from one join by key.
    """
    counted, keys, bad = [], [], []
    for table, (not_null, accepted) in COUNTED.items():
        if table not in wh.layouts:
            continue
        shown, counts = SHOWN_AS.get(table, table), wh.counted(table)
        counted += [("not_null", shown, c, counts[f"not_null|{c}"]) for c in not_null]
        for c, values in accepted.items():
            if counts[f"accepted_values|{c}"]:  # failures are the distinct bad values: read them
                bad.append(TableChecks(shown, wh.stored(table), accepted={c: values}))
            else:
                counted.append(("accepted_values", shown, c, 0))
        key = not_null[0]
        keys.append(KeyTest(shown, wh.stored(table), key, wh.layouts[table].key == key, nulls=False))
    for tc in others:
        keys += [KeyTest(tc.model_name, tc.df, c, False, c in tc.not_null) for c in tc.unique]
        if tc.accepted:
            bad.append(TableChecks(tc.model_name, tc.df, accepted=tc.accepted))
    matched = reconcile_report(daily, wh.stored("protein_source_estimates"), _K, comparisons, RECONCILE_TOLERANCE_G)
    return report_of([counted_report(wh.spark, counted), unique_report(keys), *[table_report(t) for t in bad], matched])


def reconciliation(models: dict[str, DataFrame], day: int) -> DataFrame:
    """Respondents whose day total and item sum of protein differ by more than 0.1 g."""
    return reconcile_failures(models["respondent_daily"], models["protein_source_estimates"],
                              "respondent_key", f"day_{day}_protein_g", f"day_{day}_item_protein_g",
                              RECONCILE_TOLERANCE_G)


def full_report(stg: dict[str, DataFrame], models: dict[str, DataFrame], group_map: DataFrame) -> DataFrame:
    singular = [(f"protein_item_totals_match_day_{d}", "respondent_daily", reconciliation(models, d))
                for d in (1, 2)]
    return quality_report(model_checks(stg, models, group_map), singular)
