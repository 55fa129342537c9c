"""Banding, ratio and flag expressions (DRV1-DRV14, FN11-FN15).

Builders take Spark SQL expression text and return expression text. Generic
builders take their cut points and labels as parameters; the domain bands
below are thin calls with the models' fixed values. Double literals carry
the ``D`` suffix: a bare ``8.0`` in Spark SQL is a decimal.
"""

from __future__ import annotations

from collections.abc import Sequence


def lit(v) -> str:
    """SQL literal: strings quoted, floats as doubles, None as NULL."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        # Spark SQL string literals process backslash escapes.
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        return f"{v!r}D"
    return str(v)


def safe_ratio(num: str, den: str) -> str:
    """``safe_divide(num, nullif(den, 0))`` on doubles: NULL for 0 or NULL."""
    return f"try_divide(cast({num} as double), nullif(cast({den} as double), 0D))"


def closed_range_bands(value: str, ranges: Sequence[tuple[float | None, float | None, str]],
                       default: str | None) -> str:
    """CASE chain over inclusive ranges; ``None`` bounds are open.

    The first matching range wins. ``default`` is the ELSE label; ``None``
    leaves unmatched values (and NULL input) as NULL.
    """
    parts = []
    for lo, hi, label in ranges:
        if lo is not None and hi is not None:
            cond = f"{value} BETWEEN {lo} AND {hi}"
        elif lo is not None:
            cond = f"{value} >= {lo}"
        else:
            cond = f"{value} <= {hi}"
        parts.append(f"WHEN {cond} THEN {lit(label)}")
    tail = f" ELSE {lit(default)}" if default is not None else ""
    return "(CASE " + " ".join(parts) + tail + " END)"


def upper_cut_bins(value: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
    """``x < c1 -> l1, x < c2 -> l2, ..., else last``; NULL input -> last label."""
    assert len(labels) == len(cuts) + 1
    parts = [f"WHEN {value} < {lit(float(c))} THEN {lit(lbl)}" for c, lbl in zip(cuts, labels)]
    return "(CASE " + " ".join(parts) + f" ELSE {lit(labels[-1])} END)"


# Age bands, protein thresholds, glucose thresholds, kcal per
# gram of protein, cut points of the dashboard bins.
LEVINE_AGE_BANDS = [(50, 65, "50_65"), (66, None, "66_PLUS")]
LEVINE_AGE_DEFAULT = "UNDER_50"
ADULT_AGE_BANDS = [(18, 49, "18_49"), (50, 65, "50_65"), (66, None, "66_PLUS")]
ADULT_AGE_DEFAULT = "UNDER_18"
PROTEIN_GROUP_CUTS = [0.10, 0.20]
PROTEIN_GROUP_LABELS = ["LOW", "MODERATE", "HIGH"]
KCAL_PER_GRAM_PROTEIN = 4.0
ANIMAL_PROTEIN_CUTS = [25, 35, 45]
PLANT_PROTEIN_CUTS = [10, 15, 20]
QUARTILE_LABELS = ["Q1 (Low)", "Q2", "Q3", "Q4 (High)"]
GLUCOSE_DIABETES_MG_DL = 126
GLUCOSE_PREDIABETES_MG_DL = 100


def age_band_levine(age: str) -> str:
    """50-65, 66+, else (including NULL) UNDER_50."""
    return closed_range_bands(age, LEVINE_AGE_BANDS, LEVINE_AGE_DEFAULT)


def adult_age_band(age: str) -> str:
    """18-49, 50-65, 66+, else (including NULL) UNDER_18."""
    return closed_range_bands(age, ADULT_AGE_BANDS, ADULT_AGE_DEFAULT)


def paper_age_band(age: str) -> str:
    """Flow variant on the raw float age: no ELSE, so (65, 66) and NULL stay NULL."""
    return closed_range_bands(age, LEVINE_AGE_BANDS, None)


def protein_energy_share(protein_g: str, kcal: str) -> str:
    """Protein share of energy, ``(g * 4.0) / kcal`` in doubles, NULL on zero kcal."""
    return safe_ratio(f"cast({protein_g} as double) * {lit(KCAL_PER_GRAM_PROTEIN)}", kcal)


def protein_group(share: str) -> str:
    """< 0.10 LOW, < 0.20 MODERATE, else HIGH -- a NULL share is HIGH."""
    return upper_cut_bins(share, PROTEIN_GROUP_CUTS, PROTEIN_GROUP_LABELS)


def two_day_mean_share(p1: str, k1: str, p2: str, k2: str) -> str:
    """Mean-of-two-days protein share; NULL unless both day-2 values exist."""
    num = f"((cast({p1} as double) + cast({p2} as double)) / 2.0D) * {lit(KCAL_PER_GRAM_PROTEIN)}"
    den = f"(cast({k1} as double) + cast({k2} as double)) / 2.0D"
    return f"(CASE WHEN {k2} IS NOT NULL AND {p2} IS NOT NULL THEN {safe_ratio(num, den)} END)"


def glucose_category(mg_dl: str) -> str:
    """>=126 diabetes range, >=100 prediabetes, NULL missing, else normal."""
    return (f"(CASE WHEN {mg_dl} >= {GLUCOSE_DIABETES_MG_DL} THEN 'DIABETES_RANGE' "
            f"WHEN {mg_dl} >= {GLUCOSE_PREDIABETES_MG_DL} THEN 'PREDIABETES_RANGE' "
            f"WHEN {mg_dl} IS NULL THEN 'MISSING' ELSE 'NORMAL_RANGE' END)")


def equals_flag(c: str, value) -> str:
    """``cast(c = value as bool)``: three-valued, NULL for NULL input."""
    return f"({c} = {lit(value)})"


def rescale_weight(w: str, pooled_cycles: float = 8.0) -> str:
    """2-year survey weight to a pooled weight: ``w / number of cycles``."""
    return safe_ratio(w, lit(float(pooled_cycles)))


def animal_protein_bins(grams: str) -> str:
    return upper_cut_bins(grams, ANIMAL_PROTEIN_CUTS, QUARTILE_LABELS)


def plant_protein_bins(grams: str) -> str:
    return upper_cut_bins(grams, PLANT_PROTEIN_CUTS, QUARTILE_LABELS)


def category_ordinal(c: str, categories: Sequence[str]) -> str:
    """Position of ``c`` in an ordered category list (LOW < MODERATE < HIGH)."""
    return "(CASE " + " ".join(f"WHEN {c} = {lit(v)} THEN {i}" for i, v in enumerate(categories)) + " END)"
