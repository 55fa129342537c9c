"""DuckDB oracle SQL for every registered query.

Written from the rules, not along the models: bands and cut points come from
one VALUES table looked up by range, each ratio is computed once and looked up
from there, items of both days are staged once, and the item estimates are one
filtered aggregate per respondent. The landing shapes are derived again from the
driver tables.

Where DuckDB differs from the source warehouse: rounding integer cast is
``try_cast(round(x) as bigint)``; floats in keys print without ``.0``; ``||``
propagates NULL; every division goes through ``nullif``. Measures are DOUBLE
here: the inputs are exact binary fractions, so sums agree exactly with
decimal(38,9) sums. Double outputs are rounded to 6 places.
"""

from __future__ import annotations

from cohortlab.plans import notes


def fstr(x: str) -> str:
    """Float to key text: integral values without a fraction."""
    return (f"(CASE WHEN {x} % 1 = 0 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END)")


def sint(x: str) -> str:
    return f"TRY_CAST(round({x}) AS BIGINT)"


def num(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def rkey(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"{fstr(a + 'seqn')} || '|' || CAST({a}cycle_start_year AS VARCHAR) || '|' || "
            f"CAST({a}cycle_end_year AS VARCHAR)")


def R(*names: str) -> str:
    """Round double outputs to 6 places, keeping their names."""
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# ---------------------------------------------------------------- landing
_CYCLE = """
    CAST(2003 + 2 * (k % 8) AS BIGINT) AS cycle_start_year,
    CAST(2004 + 2 * (k % 8) AS BIGINT) AS cycle_end_year,
    CAST(2003 + 2 * (k % 8) AS VARCHAR) || '-' || CAST(2004 + 2 * (k % 8) AS VARCHAR) AS cycle_label,
    chr(CAST(67 + k % 8 AS INTEGER)) AS sfx"""


def _xpt_meta(asset: str, file_code_sql: str) -> str:
    return (f"{file_code_sql} AS file_code, '{asset}' AS asset_type, "
            f"'landing/' || CAST(cycle_start_year AS VARCHAR) || '/' || {file_code_sql} || '.xpt' AS source_url")


LANDING = f"""
l_cust AS (
  SELECT c_custkey AS k, c_nationkey, {_CYCLE} FROM customer
),
l_demo AS (
  SELECT CAST(k AS DOUBLE) AS seqn,
    CAST(3 + k % 8 AS DOUBLE) AS sddsrvyr,
    CASE WHEN k % 83 <> 82 THEN CAST((k * 7) % 86 AS DOUBLE) END AS ridageyr,
    CAST(1 + k % 2 AS DOUBLE) AS riagendr,
    CAST(1 + c_nationkey % 5 AS DOUBLE) AS ridreth1,
    CAST(1 + k % 5 AS DOUBLE) AS dmdeduc2,
    CAST(k % 41 AS DOUBLE) / 8 AS indfmpir,
    CAST(1 + k % 2 AS DOUBLE) AS sdmvpsu,
    CAST(100 + k % 15 AS DOUBLE) AS sdmvstra,
    CAST(1000 + (k * 13) % 5000 AS DOUBLE) AS wtint2yr,
    CAST(1000 + (k * 17) % 5000 AS DOUBLE) AS wtmec2yr,
    cycle_start_year, cycle_end_year, cycle_label,
    {_xpt_meta('demo', "'DEMO_' || sfx")}
  FROM l_cust
),
l_base AS (
  SELECT o.o_custkey AS k, 1 + l.l_orderkey % 2 AS day, l.l_orderkey * 10 + l.l_linenumber AS line,
    max(l.l_partkey) AS pk, sum(l.l_quantity) AS q, sum(floor(l.l_extendedprice)) AS p
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, 1 + l.l_orderkey % 2, l.l_orderkey * 10 + l.l_linenumber
),
l_items AS (
  SELECT day, k, CAST(k AS DOUBLE) AS seqn, CAST(line AS DOUBLE) AS iline,
    CASE WHEN pk % 101 <> 0 THEN CAST((pk % 11) * 10000000 + pk AS DOUBLE) END AS ifdcd,
    CASE WHEN k % 31 <> 30 THEN CAST(1000 + (k * 19) % 6000 AS DOUBLE) END AS wtdrd1,
    CAST(1000 + (k * 23) % 6000 AS DOUBLE) AS wtdr2d,
    q * 4 AS igrms,
    CAST(CASE WHEN k % 17 <> 0 THEN floor(p / (200 * (1 + k % 4))) ELSE 0 END AS DOUBLE) AS ikcal,
    CASE WHEN pk % 97 <> 0 THEN q / 8 END AS iprot,
    q / 4 AS icarb, q / 16 AS itfat,
    CAST(1 + pk % 9 AS DOUBLE) AS i030z, CAST(1 + pk % 2 AS DOUBLE) AS i040z,
    {_CYCLE}
  FROM l_base
),
l_dr1iff AS (
  SELECT *, {_xpt_meta('dr1iff', "'DR1IFF_' || sfx")} FROM l_items WHERE day = 1
),
l_dr2iff AS (
  SELECT *, {_xpt_meta('dr2iff', "'DR2IFF_' || sfx")} FROM l_items WHERE day = 2
),
l_tot AS (
  SELECT day, k, sum(ikcal) AS tkcal, sum(iprot) AS tprot, sum(icarb) AS tcarb, sum(itfat) AS ttfat
  FROM l_items
  WHERE (day = 1 AND k % 19 <> 0) OR (day = 2 AND k % 13 <> 0)
  GROUP BY day, k
),
l_tot_meta AS (
  SELECT day, CAST(k AS DOUBLE) AS seqn,
    CASE WHEN day = 1 THEN (CASE WHEN k % 31 <> 30 THEN CAST(1000 + (k * 19) % 6000 AS DOUBLE) END)
         ELSE CAST(1000 + (k * 23) % 6000 AS DOUBLE) END AS wt,
    1.0::DOUBLE AS drstz, tkcal, tprot, tcarb, ttfat, {_CYCLE}
  FROM l_tot
),
l_dr1tot AS (SELECT *, {_xpt_meta('dr1tot', "'DR1TOT_' || sfx")} FROM l_tot_meta WHERE day = 1),
l_dr2tot AS (SELECT *, {_xpt_meta('dr2tot', "'DR2TOT_' || sfx")} FROM l_tot_meta WHERE day = 2),
l_glu AS (
  SELECT CAST(k AS DOUBLE) AS seqn,
    CAST(2000 + (k * 29) % 7000 AS DOUBLE) AS wtsaf2yr,
    CASE WHEN k % 23 <> 0 THEN CAST(70 + (k * 11) % 90 AS DOUBLE) END AS lbxglu,
    CASE WHEN k % 23 <> 0 THEN CAST(70 + (k * 11) % 90 AS DOUBLE) END / 16 AS lbdglusi,
    CAST(8 + k % 8 AS DOUBLE) AS phafsthr,
    CAST(k % 60 AS DOUBLE) AS phafstmn,
    CAST(k % 40 AS DOUBLE) / 2 AS lbxin,
    CAST(k % 40 AS DOUBLE) * 3 AS lbdinsi,
    cycle_start_year, cycle_end_year, cycle_label,
    {_xpt_meta('glu', "CASE WHEN sfx = 'C' THEN 'L10AM_C' ELSE 'GLU_' || sfx END")}
  FROM l_cust WHERE k % 3 <> 0
),
l_mort0 AS (
  SELECT k, cycle_start_year, cycle_end_year, cycle_label,
    CASE WHEN k % 10 <> 0 THEN 1.0 ELSE 2.0 END::DOUBLE AS eligstat,
    CASE WHEN k % 10 <> 0 THEN (CASE WHEN k % 4 = 1 THEN 1.0 ELSE 0.0 END) END::DOUBLE AS mortstat,
    CAST((k * 5) % 190 AS DOUBLE) AS permth_int
  FROM l_cust WHERE k % 29 <> 0
),
l_mortality AS (
  SELECT CAST(k AS DOUBLE) AS seqn, eligstat, mortstat,
    CASE WHEN mortstat = 1 THEN lpad(CAST(1 + floor(k / 4) % 10 AS BIGINT)::VARCHAR, 3, '0') END AS ucod_leading,
    CASE WHEN mortstat = 1 THEN (CASE WHEN k % 7 = 1 THEN 1.0 ELSE 0.0 END) END::DOUBLE AS diabetes,
    CASE WHEN mortstat = 1 THEN (CASE WHEN k % 5 = 1 THEN 1.0 ELSE 0.0 END) END::DOUBLE AS hyperten,
    permth_int, greatest(permth_int - 1, 0.0) AS permth_exm,
    cycle_start_year, cycle_end_year, cycle_label,
    printf('SURVEY_%d_%d_MORT_%d_PUBLIC', cycle_start_year, cycle_end_year, 2019) AS file_code,
    'mortality' AS asset_type,
    'landing/mortality/' || printf('SURVEY_%d_%d_MORT_%d_PUBLIC', cycle_start_year, cycle_end_year, 2019) || '.dat' AS source_url,
    CAST(2019 AS BIGINT) AS mortality_public_release_year
  FROM l_mort0
)"""

# ---------------------------------------------------------------- staging
STAGING = f"""
s_demo AS (
  SELECT {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, {sint('sddsrvyr')} AS survey_cycle_code, {sint('ridageyr')} AS age_years,
    {sint('riagendr')} AS sex_code, {sint('ridreth1')} AS race_ethnicity_code,
    {sint('dmdeduc2')} AS education_code, {num('indfmpir')} AS poverty_income_ratio,
    {sint('sdmvpsu')} AS survey_psu, {sint('sdmvstra')} AS survey_strata,
    {num('wtint2yr')} AS interview_weight_2yr, {num('wtmec2yr')} AS mec_weight_2yr,
    file_code, source_url
  FROM l_demo
),
s_dr1tot AS (
  SELECT {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, {num('wt')} AS day_1_recall_weight_2yr, {sint('drstz')} AS day_1_recall_status,
    {num('tkcal')} AS day_1_energy_kcal, {num('tprot')} AS day_1_protein_g,
    {num('tcarb')} AS day_1_carb_g, {num('ttfat')} AS day_1_fat_g, file_code, source_url
  FROM l_dr1tot
),
s_dr2tot AS (
  SELECT {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, {num('wt')} AS day_2_recall_weight_2yr, {sint('drstz')} AS day_2_recall_status,
    {num('tkcal')} AS day_2_energy_kcal, {num('tprot')} AS day_2_protein_g,
    {num('tcarb')} AS day_2_carb_g, {num('ttfat')} AS day_2_fat_g, file_code, source_url
  FROM l_dr2tot
),
s_items AS (
  SELECT day, {rkey()} || '|' || CAST(day AS VARCHAR) || '|' || {fstr('iline')} AS protein_item_key,
    {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year, cycle_label,
    {sint('iline')} AS food_line_number, {sint('ifdcd')} AS food_code,
    lpad(CAST({sint('ifdcd')} AS VARCHAR), 8, '0') AS food_code_padded,
    CAST(left(lpad(CAST({sint('ifdcd')} AS VARCHAR), 8, '0'), 1) AS BIGINT) AS food_code_major_group,
    {num('wtdrd1')} AS w1, {num('wtdr2d')} AS w2, {num('igrms')} AS intake_grams,
    {num('ikcal')} AS energy_kcal, {num('iprot')} AS protein_g, {num('icarb')} AS carb_g, {num('itfat')} AS fat_g,
    {fstr('i030z')} AS eating_occasion, {fstr('i040z')} AS ate_at_home_response,
    'DR' || CAST(day AS VARCHAR) || 'IFF_' || sfx AS file_code,
    'landing/' || CAST(cycle_start_year AS VARCHAR) || '/DR' || CAST(day AS VARCHAR) || 'IFF_' || sfx || '.xpt' AS source_url
  FROM l_items
),
s_dr1iff AS (SELECT * EXCLUDE (day, w1, w2), w1 AS day_1_recall_weight_2yr, w2 AS two_day_recall_weight_2yr
             FROM s_items WHERE day = 1),
s_dr2iff AS (SELECT * EXCLUDE (day, w1, w2), w2 AS day_2_recall_weight_2yr FROM s_items WHERE day = 2),
s_glu AS (
  SELECT {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, {num('wtsaf2yr')} AS fasting_weight_2yr, {num('lbxglu')} AS fasting_glucose_mg_dl,
    {num('lbdglusi')} AS fasting_glucose_mmol_l, {num('phafsthr')} AS fasting_hours,
    {num('phafstmn')} AS fasting_minutes, {num('lbxin')} AS fasting_insulin_uuml,
    {num('lbdinsi')} AS fasting_insulin_pmol_l, file_code, source_url
  FROM l_glu
),
s_mortality AS (
  SELECT {rkey()} AS respondent_key, {sint('seqn')} AS respondent_id,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, {sint('eligstat')} AS eligibility_status, {sint('mortstat')} AS mortality_status,
    CAST(ucod_leading AS VARCHAR) AS underlying_cause_group_code,
    {sint('diabetes')} AS diabetes_mentioned_flag, {sint('hyperten')} AS hypertension_mentioned_flag,
    {num('permth_int')} AS followup_months_interview, {num('permth_exm')} AS followup_months_exam,
    {sint('mortality_public_release_year')} AS mortality_public_release_year, file_code, source_url
  FROM l_mortality
),
s_group_map AS (
  SELECT * FROM (VALUES
    (1, 'Milk and milk products', 'animal', 'fndds_major_group_heuristic', 'Dairy-coded foods are treated as animal-derived protein.'),
    (2, 'Meat poultry fish and mixtures', 'animal', 'fndds_major_group_heuristic', 'Meat-centered food codes are treated as animal-derived protein.'),
    (3, 'Eggs', 'animal', 'fndds_major_group_heuristic', 'Egg food codes are treated as animal-derived protein.'),
    (4, 'Legumes nuts and seeds', 'plant', 'fndds_major_group_heuristic', 'Legume and nut food codes are treated as plant-derived protein.'),
    (5, 'Grain products', 'plant', 'fndds_major_group_heuristic', 'Grain-coded foods are treated as plant-derived protein unless a richer mapping is added later.'),
    (6, 'Fruits', 'plant', 'fndds_major_group_heuristic', 'Fruit-coded foods are treated as plant-derived protein.'),
    (7, 'Vegetables', 'plant', 'fndds_major_group_heuristic', 'Vegetable-coded foods are treated as plant-derived protein.'),
    (8, 'Fats oils and salad dressings', 'unclassified', 'fndds_major_group_heuristic', 'These foods are typically low-protein or source-ambiguous and remain unclassified.'),
    (9, 'Sugars sweets and beverages', 'unclassified', 'fndds_major_group_heuristic', 'These foods mix plant and animal ingredients and remain unclassified in the initial seed.')
  ) AS t(food_code_major_group, major_group_label, protein_source_group, classification_method, classification_notes)
)"""

# ---------------------------------------------------------------- models
# One table of all bands: kind, lowest value (inclusive), next (exclusive), label.
BANDS = """
bands(kind, lo, hi, label) AS (VALUES
  ('levine', -1e18, 50, 'UNDER_50'), ('levine', 50, 66, '50_65'), ('levine', 66, 1e18, '66_PLUS'),
  ('adult', -1e18, 18, 'UNDER_18'), ('adult', 18, 50, '18_49'), ('adult', 50, 66, '50_65'), ('adult', 66, 1e18, '66_PLUS'),
  ('protein', -1e18, 0.1, 'LOW'), ('protein', 0.1, 0.2, 'MODERATE'), ('protein', 0.2, 1e18, 'HIGH'),
  ('glucose', -1e18, 100, 'NORMAL_RANGE'), ('glucose', 100, 126, 'PREDIABETES_RANGE'), ('glucose', 126, 1e18, 'DIABETES_RANGE'),
  ('animal', -1e18, 25, 'Q1 (Low)'), ('animal', 25, 35, 'Q2'), ('animal', 35, 45, 'Q3'), ('animal', 45, 1e18, 'Q4 (High)'),
  ('plant', -1e18, 10, 'Q1 (Low)'), ('plant', 10, 15, 'Q2'), ('plant', 15, 20, 'Q3'), ('plant', 20, 1e18, 'Q4 (High)'))"""


def band(kind: str, x: str, missing: str | None = None) -> str:
    """Label of ``x`` in the bands of a kind; ``missing`` for NULL."""
    found = f"(SELECT b.label FROM bands b WHERE b.kind = '{kind}' AND {x} >= b.lo AND {x} < b.hi)"
    return found if missing is None else f"coalesce({found}, '{missing}')"


def _estimates() -> str:
    """One filtered aggregate per respondent; a day without items stays NULL."""
    out = []
    for d in (1, 2):
        on = f"recall_day = {d}"
        some = f"CASE WHEN count(*) FILTER (WHERE {on}) > 0 THEN 0 END"
        out.append(f"sum(protein_g) FILTER (WHERE {on}) AS day_{d}_item_protein_g")
        out.append(f"sum(energy_kcal) FILTER (WHERE {on}) AS day_{d}_item_energy_kcal")
        for group, name in (("animal", "animal_protein_g_est"), ("plant", "plant_protein_g_est"),
                            ("unclassified", "unclassified_protein_g")):
            mine = f"FILTER (WHERE {on} AND protein_source_group = '{group}')"
            out.append(f"coalesce(sum(protein_g) {mine}, {some}) AS day_{d}_{name}")
            out.append(f"CAST(CASE WHEN {some} = 0 THEN count(*) {mine} END AS BIGINT) AS day_{d}_{group}_item_count")
    return ",\n    ".join(out)


def _shares() -> str:
    return ",\n    ".join(
        f"day_{d}_{part} / nullif(day_{d}_item_protein_g, 0) AS day_{d}_{share}" for d in (1, 2)
        for part, share in (("animal_protein_g_est", "animal_protein_share_est"),
                            ("plant_protein_g_est", "plant_protein_share_est"),
                            ("unclassified_protein_g", "unclassified_protein_share")))


_IDENTITY = "respondent_id, cycle_start_year, cycle_end_year, cycle_label"
_SUMMARY_MEANS = {"protein_pct_kcal_day_1": "avg_protein_pct_kcal_day_1",
                  "protein_pct_kcal_mean_2day": "avg_protein_pct_kcal_mean_2day",
                  "day_1_animal_protein_share_est": "avg_day_1_animal_protein_share_est",
                  "day_1_plant_protein_share_est": "avg_day_1_plant_protein_share_est",
                  "fasting_glucose_mg_dl": "avg_fasting_glucose_mg_dl",
                  "followup_months_interview": "avg_followup_months_interview",
                  "followup_months_exam": "avg_followup_months_exam"}
_TREND_MEANS = ("day_1_energy_kcal", "day_1_protein_g", "protein_pct_kcal_day_1", "day_1_animal_protein_share_est",
                "day_1_plant_protein_share_est", "fasting_glucose_mg_dl")


def _weighted(flag: str) -> str:
    return f"coalesce(sum(day_1_recall_weight_16yr) FILTER (WHERE {flag}), 0)"


MODELS = BANDS + f""",
m_daily AS (
  SELECT s_demo.* EXCLUDE (file_code, source_url),
    a.* EXCLUDE (respondent_key, {_IDENTITY}, file_code, source_url),
    b.* EXCLUDE (respondent_key, {_IDENTITY}, file_code, source_url),
    g.* EXCLUDE (respondent_key, {_IDENTITY}, file_code, source_url),
    m.* EXCLUDE (respondent_key, {_IDENTITY}, file_code, source_url),
    m.eligibility_status = 1 AS mortality_eligible_flag, m.mortality_status = 1 AS died_during_followup,
    {band('levine', 's_demo.age_years', 'UNDER_50')} AS age_band_levine,
    {band('adult', 's_demo.age_years', 'UNDER_18')} AS adult_age_band
  FROM s_demo
  LEFT JOIN s_mortality m ON m.respondent_key = s_demo.respondent_key
  LEFT JOIN s_glu g ON g.respondent_key = s_demo.respondent_key
  LEFT JOIN s_dr2tot b ON b.respondent_key = s_demo.respondent_key
  LEFT JOIN s_dr1tot a ON a.respondent_key = s_demo.respondent_key
),
m_items AS (
  SELECT i.* EXCLUDE (day, w1, w2, file_code, source_url), i.day AS recall_day,
    list_extract([i.w1, i.w2], CAST(i.day AS BIGINT)) AS recall_day_weight_2yr,
    coalesce(m.major_group_label, 'Unknown') AS major_group_label,
    coalesce(m.protein_source_group, 'unclassified') AS protein_source_group,
    coalesce(m.classification_method, 'fndds_major_group_heuristic') AS classification_method,
    coalesce(m.classification_notes, 'No major-group mapping was available for this food code.') AS classification_notes
  FROM s_items i LEFT JOIN s_group_map m USING (food_code_major_group)
  WHERE i.protein_g IS NOT NULL
),
m_sums AS (
  SELECT respondent_key, {_IDENTITY},
    {_estimates()}
  FROM m_items GROUP BY ALL
),
m_sources AS (
  SELECT *,
    {_shares()}
  FROM m_sums
),
m_scored AS (
  SELECT d.*, p.* EXCLUDE (respondent_key, {_IDENTITY}),
    4 * d.day_1_protein_g / nullif(d.day_1_energy_kcal, 0) AS protein_pct_kcal_day_1
  FROM m_daily d LEFT JOIN m_sources p ON p.respondent_key = d.respondent_key
  WHERE d.day_1_energy_kcal + d.day_1_protein_g IS NOT NULL
),
m_grouped AS (
  SELECT *, {band('protein', 'protein_pct_kcal_day_1', 'HIGH')} AS protein_group_day_1 FROM m_scored
),
m_cohort AS (
  SELECT * EXCLUDE (mortality_eligible_flag, adult_age_band, eligibility_status, day_1_recall_status,
      day_2_recall_status, diabetes_mentioned_flag, hypertension_mentioned_flag,
      day_1_animal_item_count, day_1_plant_item_count, day_1_unclassified_item_count,
      day_2_animal_item_count, day_2_plant_item_count, day_2_unclassified_item_count),
    mec_weight_2yr * 0.125 AS mec_weight_16yr, fasting_weight_2yr * 0.125 AS fasting_weight_16yr,
    day_1_recall_weight_2yr * 0.125 AS day_1_recall_weight_16yr,
    day_2_recall_weight_2yr * 0.125 AS day_2_recall_weight_16yr,
    4 * (day_1_protein_g + day_2_protein_g) / nullif(day_1_energy_kcal + day_2_energy_kcal, 0) AS protein_pct_kcal_mean_2day,
    4 * day_1_animal_protein_g_est / nullif(day_1_energy_kcal, 0) AS day_1_animal_protein_pct_kcal_est,
    4 * day_1_plant_protein_g_est / nullif(day_1_energy_kcal, 0) AS day_1_plant_protein_pct_kcal_est,
    {band('glucose', 'fasting_glucose_mg_dl', 'MISSING')} AS fasting_glucose_category,
    underlying_cause_group_code = '002' AS cancer_death_flag,
    diabetes_mentioned_flag = 1 AS diabetes_mcod_flag, hypertension_mentioned_flag = 1 AS hypertension_mcod_flag,
    '{notes.COHORT_NOTE}' AS comparability_note, '{notes.SOURCE_NOTE}' AS protein_source_note
  FROM m_grouped WHERE mortality_eligible_flag AND age_years >= 50
),
m_summary AS (
  SELECT concat_ws('|', age_band_levine, protein_group_day_1) AS summary_key, age_band_levine, protein_group_day_1,
    count(*) AS respondent_n,
    {_weighted('true')} AS weighted_population_day_1,
    {_weighted('died_during_followup')} AS weighted_all_cause_deaths,
    {_weighted('cancer_death_flag')} AS weighted_cancer_deaths,
    {_weighted('diabetes_mcod_flag')} AS weighted_diabetes_mentions,
    {", ".join(f"avg({c}) AS {n}" for c, n in _SUMMARY_MEANS.items())}
  FROM m_cohort GROUP BY ALL
),
m_trends AS (
  SELECT concat_ws('|', cycle_label, adult_age_band, protein_group_day_1) AS trend_key,
    cycle_start_year, cycle_end_year, cycle_label, adult_age_band, protein_group_day_1,
    count(*) AS respondent_n, coalesce(sum(day_1_recall_weight_2yr), 0) AS weighted_population_2yr,
    {", ".join(f"avg({c}) AS avg_{c}" for c in _TREND_MEANS)}
  FROM m_grouped WHERE age_years >= 18 GROUP BY ALL
)"""

CTES = ",".join([LANDING, STAGING, MODELS])


def second_release(text: str) -> str:
    """The same with cycle 2009 from a release of 2021, from which a fifth of its respondents is missing."""
    old = "FROM l_cust WHERE k % 29 <> 0"
    year = "CAST(2019 AS BIGINT) AS mortality_public_release_year"
    assert old in text and year in text
    return (text.replace(old, f"{old} AND NOT (cycle_start_year = 2009 AND k % 5 = 0)")
            .replace(year, "CAST(CASE WHEN cycle_start_year = 2009 THEN 2021 ELSE 2019 END AS BIGINT) AS mortality_public_release_year"))


def with_ctes(select: str) -> str:
    return f"WITH {CTES}\n{select}"


def final(cte: str, doubles: list[str], order: str = "") -> str:
    """``SELECT *`` from a model CTE with its double columns rounded."""
    rep = f" REPLACE ({R(*doubles)})" if doubles else ""
    return with_ctes(f"SELECT *{rep} FROM {cte}{order}")


def _day(d: int, stems: list[str]) -> list[str]:
    return [f"day_{d}_{s}" for s in stems]


_TOT = ["recall_weight_2yr", "energy_kcal", "protein_g", "carb_g", "fat_g"]
_ITEM_MEASURES = ["intake_grams", "energy_kcal", "protein_g", "carb_g", "fat_g"]
_GLU = ["fasting_weight_2yr", "fasting_glucose_mg_dl", "fasting_glucose_mmol_l", "fasting_hours",
        "fasting_minutes", "fasting_insulin_uuml", "fasting_insulin_pmol_l"]
_FOLLOW = ["followup_months_interview", "followup_months_exam"]
_DEMO = ["poverty_income_ratio", "interview_weight_2yr", "mec_weight_2yr"]
_SRC = ["item_protein_g", "item_energy_kcal", "animal_protein_g_est", "plant_protein_g_est",
        "unclassified_protein_g", "animal_protein_share_est", "plant_protein_share_est",
        "unclassified_protein_share"]

ORACLE: dict[str, str] = {
    "stg_demo": final("s_demo", _DEMO),
    "stg_totals_day_1": final("s_dr1tot", _day(1, _TOT)),
    "stg_totals_day_2": final("s_dr2tot", _day(2, _TOT)),
    "stg_items_day_1": final("s_dr1iff", ["day_1_recall_weight_2yr", "two_day_recall_weight_2yr", *_ITEM_MEASURES]),
    "stg_items_day_2": final("s_dr2iff", ["day_2_recall_weight_2yr", *_ITEM_MEASURES]),
    "stg_glucose": final("s_glu", _GLU),
    "stg_mortality": final("s_mortality", _FOLLOW),
    "respondent_daily": final("m_daily", [*_DEMO, "day_1_recall_weight_2yr", "day_2_recall_weight_2yr",
                                          *_day(1, _TOT[1:]), *_day(2, _TOT[1:]), *_GLU, *_FOLLOW]),
    "protein_items": final("m_items", ["recall_day_weight_2yr", *_ITEM_MEASURES]),
    "protein_source_estimates": final("m_sources", [*_day(1, _SRC), *_day(2, _SRC)]),
    "validation_cohort": final("m_cohort", [
        *_DEMO, "day_1_recall_weight_2yr", "day_2_recall_weight_2yr", "fasting_weight_2yr",
        "mec_weight_16yr", "day_1_recall_weight_16yr", "day_2_recall_weight_16yr", "fasting_weight_16yr",
        *_day(1, _TOT[1:]), "protein_pct_kcal_day_1", *_day(2, _TOT[1:]), "protein_pct_kcal_mean_2day",
        *_day(1, _SRC), "day_1_animal_protein_pct_kcal_est", "day_1_plant_protein_pct_kcal_est",
        *_day(2, _SRC), *_GLU[1:], *_FOLLOW]),
    "validation_summary": final("m_summary", [
        "weighted_population_day_1", "weighted_all_cause_deaths", "weighted_cancer_deaths",
        "weighted_diabetes_mentions", "avg_protein_pct_kcal_day_1", "avg_protein_pct_kcal_mean_2day",
        "avg_day_1_animal_protein_share_est", "avg_day_1_plant_protein_share_est",
        "avg_fasting_glucose_mg_dl", "avg_followup_months_interview", "avg_followup_months_exam"]),
    "cycle_trends": final("m_trends", [
        "weighted_population_2yr", "avg_day_1_energy_kcal", "avg_day_1_protein_g",
        "avg_protein_pct_kcal_day_1", "avg_day_1_animal_protein_share_est",
        "avg_day_1_plant_protein_share_est", "avg_fasting_glucose_mg_dl"]),
}

_AGE_DISPLAY = "CASE {c} WHEN '50_65' THEN '50-65' WHEN '66_PLUS' THEN '66+' ELSE {c} END"


def _rate(flag: str, w: str = "day_1_recall_weight_16yr") -> str:
    return f"sum(CASE WHEN {flag} THEN {w} ELSE 0 END) / nullif(sum({w}), 0) * 1000"


def _with_extra(extra_ctes: str, select: str) -> str:
    return f"WITH {CTES},\n{extra_ctes}\n{select}"


ORACLE["mortality_rates_long"] = _with_extra(f"""
m7_wide AS (
  SELECT age_band_levine AS age_group, protein_group_day_1 AS protein_intake,
    {_rate('died_during_followup')} AS "All-Cause Mortality",
    {_rate('cancer_death_flag')} AS "Cancer",
    {_rate('diabetes_mcod_flag')} AS "Diabetes",
    {_rate("underlying_cause_group_code IN ('001', '005')")} AS "CVD"
  FROM m_cohort
  WHERE age_band_levine IS NOT NULL AND protein_group_day_1 IS NOT NULL
  GROUP BY 1, 2
)""", f"""
SELECT {_AGE_DISPLAY.format(c='age_group')} AS age_group, protein_intake, cause,
  round(rate_per_1000, 6) AS rate_per_1000,
  CASE protein_intake WHEN 'LOW' THEN 0 WHEN 'MODERATE' THEN 1 WHEN 'HIGH' THEN 2 END AS protein_intake_order
FROM m7_wide UNPIVOT INCLUDE NULLS (rate_per_1000 FOR cause IN ("All-Cause Mortality", "Cancer", "Diabetes", "CVD"))
""")


ORACLE["source_rates_long"] = _with_extra(f"""
m8_pairs AS (
  SELECT age_band_levine, cancer_death_flag, diabetes_mcod_flag, hypertension_mcod_flag, died_during_followup,
    day_1_recall_weight_16yr, origin, grams, {band('origin', 'grams').replace("'origin'", 'origin')} AS protein_quartile
  FROM m_cohort, LATERAL (VALUES ('animal', day_1_animal_protein_g_est), ('plant', day_1_plant_protein_g_est)) v(origin, grams)
  WHERE grams IS NOT NULL AND age_band_levine IS NOT NULL
)""", f"""
SELECT {_AGE_DISPLAY.format(c='age_band_levine')} AS age_band_levine,
  upper(origin[1]) || origin[2:] || ' Protein' AS protein_type, protein_quartile, disease,
  round(1000 * coalesce(sum(day_1_recall_weight_16yr) FILTER (WHERE hit), CASE WHEN count(*) > 0 THEN 0 END)
    / nullif(sum(day_1_recall_weight_16yr), 0), 6) AS rate_per_1000
FROM m8_pairs, LATERAL (VALUES ('Cancer', cancer_death_flag), ('Diabetes', diabetes_mcod_flag),
  ('Hypertension', hypertension_mcod_flag), ('Mortality', died_during_followup)) c(disease, hit)
GROUP BY ALL
""")

_FLOW_NAMES = {  # output name: landing column
    **{c.upper(): f"d.{c}" for c in ("seqn", "cycle_start_year", "cycle_end_year", "cycle_label", "sddsrvyr", "sdmvpsu",
                                     "sdmvstra", "wtint2yr", "wtmec2yr")},
    "AGE_YEARS": "d.ridageyr", "SEX_CODE": "d.riagendr", "RACE_ETHNICITY_CODE": "d.ridreth1",
    "EDUCATION_CODE": "d.dmdeduc2", "POVERTY_INCOME_RATIO": "d.indfmpir", "WTDRD1": "a.wt", "WTDR2D": "b.wt",
    **{f"DR{n}{c.upper()}": f"{t}.{c}" for n, t in ((1, "a"), (2, "b")) for c in ("tkcal", "tprot", "tcarb", "ttfat")},
    **{c.upper(): f"g.{c}" for c in ("wtsaf2yr", "lbxglu", "lbdglusi", "phafsthr", "phafstmn")},
    **{c.upper(): f"m.{c}" for c in ("eligstat", "mortstat", "ucod_leading", "diabetes", "hyperten", "permth_int",
                                     "permth_exm", "mortality_public_release_year")},
}
# seqn fixes the cycle, so it alone joins the landing tables
FLOW = f"""
f_raw AS (
  SELECT {", ".join(f"{c} AS {n}" for n, c in _FLOW_NAMES.items())},
    4 * a.tprot / nullif(a.tkcal, 0) AS PROTEIN_PCT_KCAL_DAY1
  FROM l_mortality m JOIN l_demo d USING (seqn) JOIN l_dr1tot a USING (seqn)
  LEFT JOIN l_dr2tot b USING (seqn) LEFT JOIN l_glu g USING (seqn)
  WHERE m.eligstat = 1 AND d.ridageyr >= 50 AND a.tkcal + a.tprot IS NOT NULL
    AND d.cycle_start_year >= 2003 AND d.cycle_start_year <= 2017
),
f_cohort AS (
  SELECT *, {band('protein', 'PROTEIN_PCT_KCAL_DAY1', 'HIGH')} AS PROTEIN_GROUP_DAY1,
    4 * (DR1TPROT + DR2TPROT) / nullif(DR1TKCAL + DR2TKCAL, 0) AS PROTEIN_PCT_KCAL_MEAN_2DAY,
    -- whole years only are banded below 66
    CASE WHEN AGE_YEARS <= 65 OR AGE_YEARS >= 66 THEN {band('levine', 'AGE_YEARS')} END AS PAPER_AGE_BAND,
    WTMEC2YR * 0.125 AS WTMEC16YR, WTDRD1 * 0.125 AS WTDRD1_16YR, WTDR2D * 0.125 AS WTDR2D_16YR,
    WTSAF2YR * 0.125 AS WTSAF16YR, MORTSTAT = 1 AS DIED_DURING_FOLLOWUP, UCOD_LEADING = '002' AS CANCER_DEATH_FLAG,
    DIABETES = 1 AS DIABETES_MCOD_FLAG, {band('glucose', 'LBXGLU', 'MISSING')} AS FASTING_GLUCOSE_CATEGORY,
    '{notes.FLOW_NOTE}' AS COMPARABILITY_NOTE
  FROM f_raw
)"""

_FLOW_DOUBLES = [
    "SEQN", "SDDSRVYR", "AGE_YEARS", "SEX_CODE", "RACE_ETHNICITY_CODE", "EDUCATION_CODE",
    "POVERTY_INCOME_RATIO", "SDMVPSU", "SDMVSTRA", "WTINT2YR", "WTMEC2YR", "WTDRD1", "WTDR2D",
    "DR1TKCAL", "DR1TPROT", "DR1TCARB", "DR1TTFAT", "DR2TKCAL", "DR2TPROT", "DR2TCARB", "DR2TTFAT",
    "WTSAF2YR", "LBXGLU", "LBDGLUSI", "PHAFSTHR", "PHAFSTMN", "ELIGSTAT", "MORTSTAT", "DIABETES",
    "HYPERTEN", "PERMTH_INT", "PERMTH_EXM", "PROTEIN_PCT_KCAL_DAY1", "PROTEIN_PCT_KCAL_MEAN_2DAY",
    "WTMEC16YR", "WTDRD1_16YR", "WTDR2D_16YR", "WTSAF16YR",
]
ORACLE["flow_cohort"] = _with_extra(FLOW, f"SELECT * REPLACE ({R(*_FLOW_DOUBLES)}) FROM f_cohort")
ORACLE["flow_summary"] = _with_extra(FLOW, f"""
SELECT PAPER_AGE_BAND, PROTEIN_GROUP_DAY1, count(*) AS SAMPLE_N,
  round(sum(WTDRD1_16YR), 6) AS WEIGHTED_POPULATION,
  round(sum(CASE WHEN DIED_DURING_FOLLOWUP THEN WTDRD1_16YR ELSE 0 END), 6) AS WEIGHTED_ALL_CAUSE_DEATHS,
  round(sum(CASE WHEN CANCER_DEATH_FLAG THEN WTDRD1_16YR ELSE 0 END), 6) AS WEIGHTED_CANCER_DEATHS,
  round(avg(PERMTH_INT), 6) AS AVG_FOLLOWUP_MONTHS_FROM_INTERVIEW,
  round(avg(PERMTH_EXM), 6) AS AVG_FOLLOWUP_MONTHS_FROM_EXAM
FROM f_cohort GROUP BY PAPER_AGE_BAND, PROTEIN_GROUP_DAY1
""")


# ---------------------------------------------------------------- operator queries
def q(select: str) -> str:
    return with_ctes(select)


def _union_days(cols: str) -> str:
    return f"SELECT {cols} FROM s_dr1iff UNION ALL SELECT {cols} FROM s_dr2iff"


_SHARE1 = "4 * day_1_protein_g / nullif(day_1_energy_kcal, 0)"
_W7 = "CASE WHEN l_linenumber <> 7 THEN l_quantity END"
_CAT_PARTS = [("l_demo", "XPT"), ("l_dr1iff", "XPT"), ("l_dr2iff", "XPT"), ("l_dr1tot", "XPT"),
              ("l_dr2tot", "XPT"), ("l_glu", "XPT")]
RELEASES = """o_release AS (
  SELECT cycle_start_year, cycle_end_year, max(2011 + 4 * ((k // 8) % 3))::BIGINT AS latest_release_year
  FROM l_cust GROUP BY ALL
),
o_followup AS (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'December 31, ' || (2010 + page_id % 10)::VARCHAR END AS followup_through
  FROM pages
),
"""
CATALOG = RELEASES + "o_catalog_raw AS (" + " UNION ALL ".join(
    [f"SELECT DISTINCT asset_type, file_code, '{fmt}' AS file_format, cycle_start_year, cycle_end_year, "
     f"cycle_label, source_url, CAST(NULL AS BIGINT) AS mortality_public_release_year FROM {t}"
     for t, fmt in _CAT_PARTS]
    + ["SELECT DISTINCT asset_type, file_code, 'DAT' AS file_format, cycle_start_year, cycle_end_year, "
       "cycle_label, source_url, latest_release_year FROM l_mortality JOIN o_release USING (cycle_start_year, cycle_end_year)"]) + f"""),
o_catalog AS (
  SELECT *, (SELECT max(followup_through) FROM o_followup) AS mortality_followup_available_through,
    '{notes.CATALOG_NOTE}' AS paper_comparability_note
  FROM o_catalog_raw
),
o_stg_catalog AS (
  SELECT asset_type || '|' || file_code || '|' || CAST(cycle_start_year AS VARCHAR) || '|'
      || CAST(cycle_end_year AS VARCHAR) AS source_asset_key,
    lower(asset_type) AS asset_type, file_code, file_format,
    {sint('cycle_start_year')} AS cycle_start_year, {sint('cycle_end_year')} AS cycle_end_year,
    cycle_label, source_url, {sint('mortality_public_release_year')} AS mortality_public_release_year,
    mortality_followup_available_through, paper_comparability_note
  FROM o_catalog
)"""
def _reconcile(day: int) -> str:
    """Totals moved by 0.1 (within the tolerance) or 0.11 for some respondents, in exact decimals."""
    total = (f"CAST(d.day_{day}_protein_g AS DECIMAL(28,9)) + CASE d.respondent_id % 7 WHEN 1 THEN 0.1::DECIMAL(28,9) "
             "WHEN 2 THEN 0.11::DECIMAL(28,9) ELSE 0 END")
    return f"""
  SELECT respondent_key, {day} AS recall_day, round(t::DOUBLE, 6) AS total_protein_g, round(i::DOUBLE, 6) AS item_protein_g
  FROM (SELECT d.respondent_key, {total} AS t, CAST(p.day_{day}_item_protein_g AS DECIMAL(28,9)) AS i
        FROM m_daily d JOIN m_sources p ON p.respondent_key = d.respondent_key)
  WHERE t - i > 0.1 OR i - t > 0.1"""


_LI_WIDE = """SELECT l_returnflag, sum(l_quantity) AS sum_qty, CAST(count(*) AS DOUBLE) AS n_lines,
    max(l_quantity) AS max_qty FROM lineitem GROUP BY 1"""

ORACLE.update({
    "cast_safe_int": q(f"""SELECT l_orderkey, l_linenumber, {sint('l_quantity / 2')} AS half_qty_int,
        {sint('-l_quantity / 2')} AS neg_half_qty_int, {sint('l_discount * 100')} AS discount_pct_int
        FROM lineitem"""),
    "cast_safe_numeric": q("""SELECT c_custkey, round(TRY_CAST(c_acctbal AS DOUBLE), 6) AS acctbal_numeric,
        CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey * 1000000 + 123456)::DOUBLE + 0.789 END AS text_numeric_millionths
        FROM customer"""),
    "cast_string": q(f"""SELECT l_orderkey, l_linenumber, {fstr('l_quantity')} AS qty_text,
        {fstr('(l_quantity / 2)')} AS half_qty_text, CAST(l_linenumber AS VARCHAR) AS line_text FROM lineitem"""),
    "key_composite": q(f"""SELECT {rkey()} AS respondent_key, {fstr('seqn')} || '|' || {fstr('ridageyr')} AS seqn_age_key
        FROM l_demo"""),
    "key_item": q(_union_days("protein_item_key, respondent_key, food_line_number")),
    "flt_boolean_3vl": q("SELECT respondent_key, eligibility_status FROM m_daily WHERE mortality_eligible_flag"),
    "flt_not_null": q("""SELECT respondent_key, round(day_1_energy_kcal, 6) AS day_1_energy_kcal,
        round(day_1_protein_g, 6) AS day_1_protein_g FROM m_daily
        WHERE day_1_energy_kcal IS NOT NULL AND day_1_protein_g IS NOT NULL"""),
    "flt_between": q("SELECT respondent_key, age_years FROM s_demo WHERE age_years BETWEEN 50 AND 65"),
    "flt_in_list": q("""SELECT respondent_key, underlying_cause_group_code FROM s_mortality
        WHERE underlying_cause_group_code IN ('001', '005')"""),
    "band_age": q(f"""SELECT respondent_key, age_years, {band('levine', 'age_years', 'UNDER_50')} AS age_band_levine FROM s_demo"""),
    "band_adult_age": q(f"""SELECT respondent_key, age_years, {band('adult', 'age_years', 'UNDER_18')} AS adult_age_band FROM s_demo"""),
    "band_paper_age": q(f"""SELECT round(seqn, 6) AS SEQN, round(a, 6) AS AGE_YEARS,
        CASE WHEN a BETWEEN 50 AND 65 OR a >= 66 THEN {band('levine', 'a')} END AS PAPER_AGE_BAND
        FROM (SELECT seqn, ridageyr + CASE WHEN seqn % 2 = 1 THEN 0.5 ELSE 0.0 END AS a FROM l_demo)"""),
    "ratio_protein_energy": q(f"SELECT respondent_key, round({_SHARE1}, 6) AS protein_pct_kcal_day_1 FROM m_daily"),
    "band_protein_group": q(f"""SELECT respondent_key, round(share, 6) AS protein_pct_kcal_day_1,
        {band('protein', 'share', 'HIGH')} AS protein_group_day_1
        FROM (SELECT respondent_key, {_SHARE1} AS share FROM m_daily)"""),
    "ratio_two_day_mean": q("""SELECT respondent_key, round(4 * (day_1_protein_g + day_2_protein_g)
        / nullif(day_1_energy_kcal + day_2_energy_kcal, 0), 6) AS protein_pct_kcal_mean_2day FROM m_daily"""),
    "weight_rescale": q("""SELECT respondent_key, round(mec_weight_2yr / 8.0, 6) AS mec_weight_16yr,
        round(day_1_recall_weight_2yr / 8.0, 6) AS day_1_recall_weight_16yr,
        round(day_2_recall_weight_2yr / 8.0, 6) AS day_2_recall_weight_16yr,
        round(fasting_weight_2yr / 8.0, 6) AS fasting_weight_16yr FROM m_daily"""),
    "band_glucose": q(f"""SELECT respondent_key, round(fasting_glucose_mg_dl, 6) AS fasting_glucose_mg_dl,
        {band('glucose', 'fasting_glucose_mg_dl', 'MISSING')} AS fasting_glucose_category FROM m_daily"""),
    "flag_nullable": q("""SELECT respondent_key, mortality_eligible_flag, died_during_followup,
        CAST(underlying_cause_group_code = '002' AS BOOLEAN) AS cancer_death_flag,
        CAST(diabetes_mentioned_flag = 1 AS BOOLEAN) AS diabetes_mcod_flag,
        CAST(hypertension_mentioned_flag = 1 AS BOOLEAN) AS hypertension_mcod_flag FROM m_daily"""),
    "food_major_group": q(_union_days("protein_item_key, food_code, food_code_padded, food_code_major_group")),
    "band_animal_bins": q(f"""SELECT respondent_key, round(day_1_animal_protein_g_est, 6) AS day_1_animal_protein_g_est,
        {band('animal', 'day_1_animal_protein_g_est')} AS protein_quartile FROM m_sources
        WHERE day_1_animal_protein_g_est IS NOT NULL"""),
    "band_plant_bins": q(f"""SELECT respondent_key, round(day_1_plant_protein_g_est, 6) AS day_1_plant_protein_g_est,
        {band('plant', 'day_1_plant_protein_g_est')} AS protein_quartile FROM m_sources
        WHERE day_1_plant_protein_g_est IS NOT NULL"""),
    "label_title_case": q("SELECT event_id, 'First ' || upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS label FROM events"),
    "join_left_star": q("""SELECT d.respondent_key, d.age_years, round(t1.day_1_protein_g, 6) AS day_1_protein_g,
        round(t2.day_2_protein_g, 6) AS day_2_protein_g, round(g.fasting_glucose_mg_dl, 6) AS fasting_glucose_mg_dl,
        m.mortality_status
        FROM s_demo d LEFT JOIN s_dr1tot t1 USING (respondent_key) LEFT JOIN s_dr2tot t2 USING (respondent_key)
        LEFT JOIN s_glu g USING (respondent_key) LEFT JOIN s_mortality m USING (respondent_key)"""),
    "join_left_multikey": q("""SELECT d.seqn AS SEQN, d.cycle_start_year AS CYCLE_START_YEAR,
        d.cycle_end_year AS CYCLE_END_YEAR, d.ridageyr AS RIDAGEYR, t1.tprot AS DR1TPROT, m.mortstat AS MORTSTAT
        FROM l_demo d LEFT JOIN l_dr1tot t1 USING (seqn, cycle_start_year, cycle_end_year)
        LEFT JOIN l_mortality m USING (seqn, cycle_start_year, cycle_end_year)"""),
    "join_lookup_default": q("""SELECT i.protein_item_key, i.food_code_major_group,
        coalesce(m.major_group_label, 'Unknown') AS major_group_label,
        coalesce(m.protein_source_group, 'unclassified') AS protein_source_group
        FROM s_items i LEFT JOIN s_group_map m ON i.food_code_major_group = m.food_code_major_group"""),
    "agg_count": q("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2"),
    "agg_sum": q("SELECT l_linestatus, round(sum(l_quantity), 6) AS sum_qty FROM lineitem GROUP BY 1"),
    "agg_conditional_sum": q("""SELECT l_linestatus, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END), 6)
        AS returned_qty FROM lineitem GROUP BY 1"""),
    "agg_conditional_count": q("""SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT)
        AS returned_lines FROM lineitem GROUP BY 1"""),
    "agg_weighted_total": q(f"""SELECT l_returnflag, round(sum(coalesce({_W7}, 0)), 6) AS weighted_total
        FROM lineitem GROUP BY 1"""),
    "agg_weighted_conditional": q(f"""SELECT l_linestatus,
        round(sum(CASE WHEN l_returnflag = 'R' THEN coalesce({_W7}, 0) ELSE 0 END), 6) AS weighted_returned
        FROM lineitem GROUP BY 1"""),
    "agg_avg_nullable": q("""SELECT l_returnflag, round(avg(CASE WHEN l_linenumber > 3 THEN l_quantity END), 6)
        AS avg_qty_late_lines FROM lineitem GROUP BY 1"""),
    "agg_weighted_rate": q("""SELECT l_linestatus, round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)
        / nullif(sum(l_quantity), 0) * 1000, 6) AS returned_per_1000 FROM lineitem GROUP BY 1"""),
    "reshape_pivot": q("""SELECT respondent_key,
        round(sum(CASE WHEN recall_day = 1 THEN protein_g END), 6) AS day_1_item_protein_g,
        nullif(count(CASE WHEN recall_day = 1 THEN 1 END), 0) AS day_1_item_count,
        round(sum(CASE WHEN recall_day = 2 THEN protein_g END), 6) AS day_2_item_protein_g,
        nullif(count(CASE WHEN recall_day = 2 THEN 1 END), 0) AS day_2_item_count
        FROM m_items GROUP BY 1"""),
    "reshape_melt_all": q(f"""SELECT l_returnflag, measure, round(value, 6) AS value FROM ({_LI_WIDE})
        UNPIVOT INCLUDE NULLS (value FOR measure IN (sum_qty, n_lines, max_qty))"""),
    "reshape_melt_cols": q(f"""SELECT l_returnflag, measure, round(value, 6) AS value FROM ({_LI_WIDE})
        UNPIVOT INCLUDE NULLS (value FOR measure IN (sum_qty, max_qty))"""),
    "set_union_all": q("""SELECT protein_item_key, respondent_key, 1 AS recall_day FROM s_dr1iff
        UNION ALL SELECT protein_item_key, respondent_key, 2 AS recall_day FROM s_dr2iff"""),
    "sort_category": q("""SELECT respondent_key, protein_group_day_1, CASE protein_group_day_1 WHEN 'LOW' THEN 0
        WHEN 'MODERATE' THEN 1 WHEN 'HIGH' THEN 2 END AS protein_group_order FROM m_cohort"""),
    "scalar_functions": q(r"""SELECT c_custkey, lower(c_name) AS name_lower, upper(c_mktsegment) AS segment_upper,
        trim('  ' || c_mktsegment || ' ') AS segment_trimmed,
        lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS key_padded,
        substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 1, 1) AS key_first_digit,
        replace(c_mktsegment, 'E', 'e') AS segment_replaced,
        regexp_extract(c_name, '(\d+)$', 1) AS name_number,
        list_max(list_transform(regexp_extract_all(c_name, '(\d)', 1), lambda x: CAST(x AS INTEGER))) AS max_digit,
        coalesce(nullif(c_nationkey % 5, 0), -1) AS nation_mod_or_default,
        round(CAST(c_custkey AS DOUBLE) / nullif(CAST(c_nationkey AS DOUBLE), 0), 6) AS key_per_nation,
        round(abs(c_acctbal), 6) AS abs_acctbal,
        c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) AS formatted
        FROM customer"""),
    "src_fixed_width": q("""SELECT seqn AS SEQN, eligstat AS ELIGSTAT, mortstat AS MORTSTAT,
        ucod_leading AS UCOD_LEADING, diabetes AS DIABETES, hyperten AS HYPERTEN, permth_int AS PERMTH_INT,
        permth_exm AS PERMTH_EXM FROM l_mortality"""),
    "ing_metadata": q("""SELECT CAST(k AS DOUBLE) AS SEQN, CAST((k * 7) % 86 AS DOUBLE) AS RIDAGEYR,
        CAST(1 + k % 5 AS DOUBLE) AS DMDEDUC2,
        cycle_start_year AS CYCLE_START_YEAR, cycle_end_year AS CYCLE_END_YEAR, cycle_label AS CYCLE_LABEL,
        'DEMO_' || sfx AS FILE_CODE, 'demo' AS ASSET_TYPE,
        'landing/' || CAST(cycle_start_year AS VARCHAR) || '/DEMO_' || sfx || '.xpt' AS SOURCE_URL FROM l_cust"""),
    "ing_union_cycles": q("""SELECT CAST(k AS DOUBLE) AS SEQN, CAST((k * 7) % 86 AS DOUBLE) AS RIDAGEYR,
        CASE WHEN (k % 8) % 2 = 0 THEN CAST(1 + k % 5 AS DOUBLE) END AS DMDEDUC2,
        cycle_start_year AS CYCLE_START_YEAR, cycle_end_year AS CYCLE_END_YEAR, cycle_label AS CYCLE_LABEL,
        'DEMO_' || sfx AS FILE_CODE, 'demo' AS ASSET_TYPE,
        'landing/' || CAST(cycle_start_year AS VARCHAR) || '/DEMO_' || sfx || '.xpt' AS SOURCE_URL FROM l_cust"""),
    "ing_source_catalog": _with_extra(CATALOG, "SELECT * FROM o_catalog"),
    "stg_source_catalog": _with_extra(CATALOG, "SELECT * FROM o_stg_catalog"),
    "ing_latest_release": _with_extra(CATALOG, "SELECT * FROM o_release"),
    "ing_followup_text": _with_extra(CATALOG, "SELECT * FROM o_followup"),
    "ing_manifest": _with_extra(CATALOG, f"""SELECT '{{"dataset_window":"2003-2018","cycles":["' || (
        SELECT string_agg(DISTINCT cycle_label, '","' ORDER BY cycle_label) FROM o_catalog)
      || '"],"survey_assets":["' || (
        SELECT string_agg(DISTINCT asset_type, '","' ORDER BY asset_type) FROM o_catalog WHERE file_format = 'XPT')
      || '"],"public_mortality_release_year_by_cycle":{{"' || (
        SELECT string_agg(cycle_label || '":' || mortality_public_release_year::VARCHAR, ',"' ORDER BY cycle_label)
        FROM o_catalog WHERE file_format = 'DAT')
      || '}},"mortality_followup_available_through":"' || (SELECT max(followup_through) FROM o_followup)
      || '","linked_mortality_note":"{notes.LINKAGE_NOTE}","paper_comparability_note":"{notes.CATALOG_NOTE}"}}' AS manifest_json"""),
    "ing_incremental": q("""SELECT seqn AS SEQN, eligstat AS ELIGSTAT, mortstat AS MORTSTAT,
        ucod_leading AS UCOD_LEADING, diabetes AS DIABETES, hyperten AS HYPERTEN, permth_int AS PERMTH_INT,
        permth_exm AS PERMTH_EXM, cycle_start_year AS CYCLE_START_YEAR, cycle_end_year AS CYCLE_END_YEAR,
        mortality_public_release_year AS MORTALITY_PUBLIC_RELEASE_YEAR, cycle_label AS CYCLE_LABEL
        FROM l_mortality"""),
    "ing_load_files": q("""SELECT seqn AS SEQN, eligstat AS ELIGSTAT, mortstat AS MORTSTAT,
        ucod_leading AS UCOD_LEADING, diabetes AS DIABETES, hyperten AS HYPERTEN, permth_int AS PERMTH_INT,
        permth_exm AS PERMTH_EXM, cycle_start_year AS CYCLE_START_YEAR, cycle_end_year AS CYCLE_END_YEAR,
        cycle_label AS CYCLE_LABEL, file_code AS FILE_CODE, asset_type AS ASSET_TYPE, source_url AS SOURCE_URL,
        mortality_public_release_year AS MORTALITY_PUBLIC_RELEASE_YEAR FROM l_mortality"""),
    "snk_full_refresh_shrinks": q("""SELECT seqn AS SEQN, cycle_start_year AS CYCLE_START_YEAR FROM l_mortality
        WHERE cycle_start_year > 2010"""),
    "ing_quarantine": """SELECT CASE c_custkey % 50 WHEN 1 THEN 'line width' WHEN 2 THEN 'respondent number'
            WHEN 3 THEN 'file name' ELSE 'landed' END AS outcome,
          CASE WHEN c_custkey % 50 = 2 THEN 'x' || lpad(c_custkey::VARCHAR, 13, ' ') ELSE lpad(c_custkey::VARCHAR, 14, ' ') END
            AS start_of_line
        FROM customer WHERE c_custkey % 29 <> 0""",
    "snk_compaction": """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, 2003 + 2 * (l_orderkey % 4) AS y FROM lineitem""",
    "join_skewed_star": """WITH f AS (SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
          CASE WHEN l_orderkey % 3 = 1 THEN 1 WHEN l_orderkey % 3 = 2 THEN l_partkey END AS k FROM lineitem)
        SELECT f.*, p_name, c_name, s_name FROM f LEFT JOIN part ON p_partkey = k
        LEFT JOIN customer ON c_custkey = k LEFT JOIN supplier ON s_suppkey = k""",
    "mart_build": ORACLE["validation_cohort"],
    "mart_bucketed_join": ORACLE["respondent_daily"],
    "mart_pruned_read": q("""SELECT condition, respondent_key, cycle_start_year, age_years FROM m_cohort JOIN (VALUES
          ('one year', 2009, 2010), ('from and before', 2011, 2015), ('listed', 2003, 2004), ('listed', 2017, 2018),
          ('all but one', 0, 2005), ('all but one', 2006, 9999), ('up to', 0, 2005), ('after', 2016, 9999),
          ('between', 2006, 2010), ('known', 0, 9999)) AS c(condition, first, beyond)
        ON cycle_start_year >= first AND cycle_start_year < beyond"""),
    "mart_refresh_cycle": second_release(ORACLE["validation_cohort"]),
    "mart_refresh_summary": second_release(ORACLE["validation_summary"]),
    "mart_refresh_trends": second_release(ORACLE["cycle_trends"]),
    "flt_protein_type": f"SELECT * FROM ({ORACLE['source_rates_long']}) WHERE protein_type = 'Plant Protein'",
    "snk_overwrite_roundtrip": ORACLE["validation_summary"],
    "snk_range_partition": q("""SELECT cycle_bucket, cycle_start_year, age_band_levine, protein_group_day_1,
        count(*) AS respondent_n
        FROM (SELECT *, CASE WHEN cycle_start_year IS NOT NULL
                THEN CAST(least(greatest(floor((cycle_start_year - 2003) / 2) + 1, 0), 9) AS INTEGER) END
              AS cycle_bucket FROM m_cohort)
        GROUP BY 1, 2, 3, 4"""),
    "dq_not_null": q("SELECT respondent_key, age_years FROM s_demo WHERE age_years IS NULL"),
    "dq_unique": q("""SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dq_accepted_values": q("""SELECT event_type, count(*) AS n_records FROM events
        WHERE event_type IS NOT NULL AND event_type NOT IN ('signup', 'click', 'view', 'purchase') GROUP BY 1"""),
    "dq_reconcile": q(_reconcile(1) + "\n  UNION ALL" + _reconcile(2)),
})

# The model data tests: (model, relation, not_null, unique, accepted values).
_DQ_TABLES = [
    ("stg_source_catalog", "o_stg_catalog", ["source_asset_key"], ["source_asset_key"], {}),
    ("stg_demo", "s_demo", ["respondent_key", "respondent_id", "cycle_label"], ["respondent_key"], {}),
    ("stg_dr1tot", "s_dr1tot", ["respondent_key"], ["respondent_key"], {}),
    ("stg_dr2tot", "s_dr2tot", ["respondent_key"], ["respondent_key"], {}),
    ("stg_dr1iff", "s_dr1iff", ["protein_item_key"], ["protein_item_key"], {}),
    ("stg_dr2iff", "s_dr2iff", ["protein_item_key"], ["protein_item_key"], {}),
    ("stg_glu", "s_glu", ["respondent_key"], ["respondent_key"], {}),
    ("stg_mortality", "s_mortality", ["respondent_key"], ["respondent_key"], {}),
    ("respondent_daily", "m_daily", ["respondent_key"], ["respondent_key"],
     {"age_band_levine": ["UNDER_50", "50_65", "66_PLUS"]}),
    ("protein_items", "m_items", ["protein_item_key"], ["protein_item_key"],
     {"protein_source_group": ["animal", "plant", "unclassified"]}),
    ("protein_source_estimates", "m_sources", ["respondent_key"], ["respondent_key"], {}),
    ("validation_cohort", "m_cohort", ["respondent_key"], ["respondent_key"],
     {"age_band_levine": ["50_65", "66_PLUS"], "protein_group_day_1": ["LOW", "MODERATE", "HIGH"]}),
    ("validation_summary", "m_summary", ["summary_key"], ["summary_key"], {}),
    ("cycle_protein_trends", "m_trends", ["trend_key"], ["trend_key"],
     {"adult_age_band": ["18_49", "50_65", "66_PLUS"], "protein_group_day_1": ["LOW", "MODERATE", "HIGH"]}),
    ("food_code_major_group_map", "s_group_map", ["food_code_major_group"], ["food_code_major_group"],
     {"protein_source_group": ["animal", "plant", "unclassified"]}),
]


def _dq_report_sql() -> str:
    rows = []
    for model, rel, nn, un, acc in _DQ_TABLES:
        for c in nn:
            rows.append(f"SELECT 'not_null' AS check_name, '{model}' AS model_name, '{c}' AS column_name, "
                        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failing_rows FROM {rel}")
        for c, vals in acc.items():
            lst = ", ".join(f"'{v}'" for v in vals)
            rows.append(f"SELECT 'accepted_values', '{model}', '{c}', "
                        f"CAST(count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ({lst})) AS BIGINT) FROM {rel}")
        for c in un:
            rows.append(f"SELECT 'unique', '{model}', '{c}', CAST(count(*) AS BIGINT) FROM "
                        f"(SELECT {c} FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    for day in (1, 2):
        # the derived totals are the item sums themselves: nothing to report but what the shift moves
        rows.append(f"SELECT 'protein_item_totals_match_day_{day}', 'respondent_daily', '', CAST(count(*) AS BIGINT) "
                    f"FROM m_daily JOIN m_sources USING (respondent_key) WHERE abs(day_{day}_protein_g - day_{day}_item_protein_g) > 0.1")
        rows.append(f"SELECT 'shifted_totals_match_day_{day}', 'spoilt_daily', '', CAST(count(*) AS BIGINT) FROM ({_reconcile(day)})")
    rows.append("SELECT 'not_null', 'spoilt_cohort', 'respondent_key', 0::BIGINT")
    rows.append("SELECT 'unique', 'spoilt_cohort', 'respondent_key', 0::BIGINT")
    rows.append("SELECT 'accepted_values', 'spoilt_cohort', 'age_band_levine', count(DISTINCT respondent_id % 4)::BIGINT "
                "FROM m_cohort WHERE respondent_id % 10 = 3")
    body = "\n  UNION ALL ".join(rows)
    return _with_extra(CATALOG, f"SELECT *, failing_rows = 0 AS passed FROM (\n  {body}\n)")


ORACLE["dq_report"] = _dq_report_sql()
