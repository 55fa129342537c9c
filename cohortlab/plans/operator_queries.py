"""Operator-level queries: one per operator family.

Each reads whole driver tables (directly or through the derived landing and
model tables) and exercises one operator with its edge cases. Generic
aggregates run on ``lineitem`` with ``l_quantity`` as the weight and
``l_returnflag = 'R'`` as the flag; integer weights keep every sum exact.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortlab.functions import bands as B
from cohortlab.functions import casts as C
from cohortlab.functions.bands import lit
from cohortlab.functions.sql import aggregate, project
from cohortlab.operators import aggregates as A
from cohortlab.operators import quality as Q
from cohortlab.operators import reshape as RS
from cohortlab.operators.joins import hot_keys, left_star_join, lookup_join, spread_star_join
from cohortlab.plans import checks
from cohortlab.plans import reports as RP
from cohortlab.plans.staging import stg_mortality
from cohortlab.session import checkpoint_dir
from cohortlab.sinks import tables as SNK
from cohortlab.sources import catalog as CAT
from cohortlab.sources import ingest as ING
from cohortlab.sources import landing as L
from cohortlab.sources import seeds
from cohortlab.streaming.incremental import latest_release, newest_releases, quarantined, run_incremental, run_quarantining

KEY = "respondent_key"


def _li(spark, d):
    return L.read_driver(spark, d, "lineitem")


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _stage(spark, d):
    from cohortlab.plans.queries import stage
    return stage(spark, d)


def _dag(spark, d):
    from cohortlab.plans.queries import dag
    return dag(spark, d)


# ------------------------------------------------------------ casts and keys
def cast_safe_int(spark, d):
    return project(_li(spark, d), [
        "l_orderkey", "l_linenumber",
        f"{C.safe_int('l_quantity / 2')} AS half_qty_int",
        f"{C.safe_int('-l_quantity / 2')} AS neg_half_qty_int",
        f"{C.safe_int('l_discount * 100')} AS discount_pct_int"])


_ACCOUNT_TEXT = "(CASE WHEN c_custkey % 5 = 0 THEN 'n/a' ELSE concat(cast(c_custkey as string), '.1234567894') END)"


def cast_safe_numeric(spark, d):
    return project(L.read_driver(spark, d, "customer"),
                   ["c_custkey", f"{C.safe_numeric('c_acctbal')} AS acctbal_numeric",
                    # text: every fifth is no number, the others have more digits than the type keeps
                    f"{C.safe_numeric(_ACCOUNT_TEXT)} * 1000000 AS text_numeric_millionths"])


def cast_string(spark, d):
    return project(_li(spark, d), [
        "l_orderkey", "l_linenumber", f"{C.float_text('l_quantity')} AS qty_text",
        f"{C.float_text('l_quantity / 2')} AS half_qty_text", "cast(l_linenumber as string) AS line_text"])


def key_composite(spark, d):
    demo = L.demo(L.read_driver(spark, d, "customer"))
    return project(demo, [
        f"{C.respondent_key('SEQN', 'CYCLE_START_YEAR', 'CYCLE_END_YEAR')} AS {KEY}",
        f"{C.composite_key(C.float_text('SEQN'), C.float_text('RIDAGEYR'))} AS seqn_age_key"])


def _items_both(spark, d, cols: list[str]) -> DataFrame:
    s = _stage(spark, d)
    return RS.union_all_by_name([project(s[f"stg_dr{day}iff"], cols) for day in (1, 2)])


def key_item(spark, d):
    return _items_both(spark, d, ["protein_item_key", KEY, "food_line_number"])


# ------------------------------------------------------------ filters
def _daily(spark, d):
    return _dag(spark, d)["respondent_daily"]


def flt_boolean_3vl(spark, d):
    return project(_daily(spark, d), [KEY, "eligibility_status"], where="mortality_eligible_flag")


def flt_not_null(spark, d):
    return project(_daily(spark, d), [KEY, "day_1_energy_kcal", "day_1_protein_g"],
                   where="day_1_energy_kcal IS NOT NULL AND day_1_protein_g IS NOT NULL")


def flt_between(spark, d):
    return project(_stage(spark, d)["stg_demo"], [KEY, "age_years"], where="age_years BETWEEN 50 AND 65")


def flt_in_list(spark, d):
    return project(_stage(spark, d)["stg_mortality"], [KEY, "underlying_cause_group_code"],
                   where="underlying_cause_group_code IN ('001', '005')")


# ------------------------------------------------------------ bands, ratios, flags
def band_age(spark, d):
    return project(_stage(spark, d)["stg_demo"],
                   [KEY, "age_years", f"{B.age_band_levine('age_years')} AS age_band_levine"])


def band_adult_age(spark, d):
    return project(_stage(spark, d)["stg_demo"],
                   [KEY, "age_years", f"{B.adult_age_band('age_years')} AS adult_age_band"])


def band_paper_age(spark, d):
    demo = L.demo(L.read_driver(spark, d, "customer"))
    raw_age = "(RIDAGEYR + CASE WHEN SEQN % 2 = 1 THEN 0.5D ELSE 0.0D END)"
    return project(demo, ["SEQN", f"{raw_age} AS AGE_YEARS", f"{B.paper_age_band(raw_age)} AS PAPER_AGE_BAND"])


_SHARE1 = B.protein_energy_share("day_1_protein_g", "day_1_energy_kcal")


def ratio_protein_energy(spark, d):
    return project(_daily(spark, d), [KEY, f"{_SHARE1} AS protein_pct_kcal_day_1"])


def band_protein_group(spark, d):
    return project(_daily(spark, d), [KEY, f"{_SHARE1} AS protein_pct_kcal_day_1",
                                      f"{B.protein_group(_SHARE1)} AS protein_group_day_1"])


def ratio_two_day_mean(spark, d):
    share = B.two_day_mean_share("day_1_protein_g", "day_1_energy_kcal", "day_2_protein_g", "day_2_energy_kcal")
    return project(_daily(spark, d), [KEY, f"{share} AS protein_pct_kcal_mean_2day"])


def weight_rescale(spark, d):
    ws = ("mec_weight_2yr", "day_1_recall_weight_2yr", "day_2_recall_weight_2yr", "fasting_weight_2yr")
    return project(_daily(spark, d), [KEY, *[
        f"{B.rescale_weight(w, 8.0)} AS {w.replace('_2yr', '_16yr')}" for w in ws]])


def band_glucose(spark, d):
    return project(_daily(spark, d), [
        KEY, "fasting_glucose_mg_dl", f"{B.glucose_category('fasting_glucose_mg_dl')} AS fasting_glucose_category"])


def flag_nullable(spark, d):
    return project(_daily(spark, d), [
        KEY, "mortality_eligible_flag", "died_during_followup",
        f"{B.equals_flag('underlying_cause_group_code', '002')} AS cancer_death_flag",
        f"{B.equals_flag('diabetes_mentioned_flag', 1)} AS diabetes_mcod_flag",
        f"{B.equals_flag('hypertension_mentioned_flag', 1)} AS hypertension_mcod_flag"])


def food_major_group(spark, d):
    return _items_both(spark, d, ["protein_item_key", "food_code", "food_code_padded", "food_code_major_group"])


def band_animal_bins(spark, d):
    g = "day_1_animal_protein_g_est"
    return project(_dag(spark, d)["protein_source_estimates"],
                   [KEY, g, f"{B.animal_protein_bins(g)} AS protein_quartile"], where=f"{g} IS NOT NULL")


def band_plant_bins(spark, d):
    g = "day_1_plant_protein_g_est"
    return project(_dag(spark, d)["protein_source_estimates"],
                   [KEY, g, f"{B.plant_protein_bins(g)} AS protein_quartile"], where=f"{g} IS NOT NULL")


def label_title_case(spark, d):
    ev = L.read_driver(spark, d, "events")
    label = RS.title_label("concat('first_', event_type, '_rate')")
    return project(ev, ["event_id", f"{label} AS label"])


# ------------------------------------------------------------ joins
def join_left_star(spark, d):
    s = _stage(spark, d)
    return left_star_join(
        project(s["stg_demo"], [KEY, "age_years"]),
        [project(s["stg_dr1tot"], [KEY, "day_1_protein_g"]), project(s["stg_dr2tot"], [KEY, "day_2_protein_g"]),
         project(s["stg_glu"], [KEY, "fasting_glucose_mg_dl"]), project(s["stg_mortality"], [KEY, "mortality_status"])],
        KEY)


L_RAW_KEY = ["SEQN", "CYCLE_START_YEAR", "CYCLE_END_YEAR"]


def join_skewed_star(spark, d):
    """JN1 under skew: a third of the order lines has no key and another third one key."""
    fact = project(_li(spark, d), ["l_orderkey", "l_linenumber", "l_quantity",
                                   "CASE l_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE l_partkey END AS k"])
    dims = [project(L.read_driver(spark, d, t), [f"{key} AS k", f"{name}"])
            for t, key, name in (("part", "p_partkey", "p_name"), ("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"))]
    return spread_star_join(fact, dims, "k", hot_keys(fact, "k", 100))


def join_left_multikey(spark, d):
    lt = L.landed_tables(spark, d)
    return left_star_join(
        project(lt["demo"], [*L_RAW_KEY, "RIDAGEYR"]),
        [project(lt["dr1tot"], [*L_RAW_KEY, "DR1TPROT"]), project(lt["mortality"], [*L_RAW_KEY, "MORTSTAT"])],
        L_RAW_KEY)


def join_lookup_default(spark, d):
    s = _stage(spark, d)
    items = RS.union_all_by_name([project(s[f"stg_dr{day}iff"], ["protein_item_key", "food_code_major_group"])
                                  for day in (1, 2)])
    gm = project(seeds.group_map(spark), ["food_code_major_group", "major_group_label", "protein_source_group"])
    return lookup_join(items, gm, "food_code_major_group",
                       {"major_group_label": "Unknown", "protein_source_group": "unclassified"},
                       dim_row_bound=seeds.GROUP_MAP_MAX_ROWS)


# ------------------------------------------------------------ aggregates
_FLAG = "l_returnflag = 'R'"
_W7 = "CASE WHEN l_linenumber <> 7 THEN l_quantity END"


def agg_count(spark, d):
    return aggregate(_li(spark, d), ["l_returnflag", "l_linestatus"], ["count(1) AS n"])


def agg_sum(spark, d):
    return aggregate(_li(spark, d), ["l_linestatus"], ["sum(l_quantity) AS sum_qty"])


def agg_conditional_sum(spark, d):
    return aggregate(_li(spark, d), ["l_linestatus"], [f"{A.conditional_sum(_FLAG, 'l_quantity')} AS returned_qty"])


def agg_conditional_count(spark, d):
    return aggregate(_li(spark, d), ["l_linestatus"], [f"{A.conditional_count(_FLAG)} AS returned_lines"])


def agg_weighted_total(spark, d):
    return aggregate(_li(spark, d), ["l_returnflag"], [f"{A.weighted_total(_W7)} AS weighted_total"])


def agg_weighted_conditional(spark, d):
    return aggregate(_li(spark, d), ["l_linestatus"], [f"{A.weighted_conditional(_FLAG, _W7)} AS weighted_returned"])


def agg_avg_nullable(spark, d):
    return aggregate(_li(spark, d), ["l_returnflag"],
                     [f"{A.mean('CASE WHEN l_linenumber > 3 THEN l_quantity END')} AS avg_qty_late_lines"])


def agg_weighted_rate(spark, d):
    return aggregate(_li(spark, d), ["l_linestatus"], [f"{A.weighted_rate(_FLAG, 'l_quantity')} AS returned_per_1000"])


# ------------------------------------------------------------ reshape, set, order
def reshape_pivot(spark, d):
    items = _dag(spark, d)["protein_items"]
    return RS.pivot_wide(items, [KEY], "recall_day", [1, 2],
                         {"item_protein_g": lambda on: f"sum(CASE WHEN {on} THEN protein_g END)",
                          "item_count": lambda on: f"nullif(count(CASE WHEN {on} THEN 1 END), 0)"},
                         lambda v, stem: f"day_{v}_{stem}")


def _li_wide(spark, d):
    return aggregate(_li(spark, d), ["l_returnflag"], [
        "sum(l_quantity) AS sum_qty", "cast(count(1) as double) AS n_lines", "max(l_quantity) AS max_qty"])


def reshape_melt_all(spark, d):
    return RS.melt(_li_wide(spark, d), ["l_returnflag"], None, "measure", "value")


def reshape_melt_cols(spark, d):
    return RS.melt(_li_wide(spark, d), ["l_returnflag"], ["sum_qty", "max_qty"], "measure", "value")


def set_union_all(spark, d):
    s = _stage(spark, d)
    return RS.union_all_by_name([
        project(s[f"stg_dr{day}iff"], ["protein_item_key", KEY, f"{day} AS recall_day"]) for day in (1, 2)])


def sort_category(spark, d):
    cohort = project(_dag(spark, d)["validation_cohort"], [KEY, "protein_group_day_1"])
    return RS.order_by_category(cohort, "protein_group_day_1", ["LOW", "MODERATE", "HIGH"], "protein_group_order", [KEY])


def scalar_functions(spark, d):
    padded = "lpad(cast(c_custkey as string), 8, '0')"
    return project(L.read_driver(spark, d, "customer"), [
        "c_custkey",
        "lower(c_name) AS name_lower",
        "upper(c_mktsegment) AS segment_upper",
        "trim(concat('  ', c_mktsegment, ' ')) AS segment_trimmed",
        f"{padded} AS key_padded",
        f"substring({padded}, 1, 1) AS key_first_digit",
        "replace(c_mktsegment, 'E', 'e') AS segment_replaced",
        f"regexp_extract(c_name, {lit(r'(\d+)$')}, 1) AS name_number",
        f"array_max(transform(regexp_extract_all(c_name, {lit(r'(\d)')}, 1), x -> cast(x as int))) AS max_digit",
        "coalesce(nullif(c_nationkey % 5, 0), -1) AS nation_mod_or_default",
        f"{B.safe_ratio('c_custkey', 'c_nationkey')} AS key_per_nation",
        "abs(c_acctbal) AS abs_acctbal",
        "format_string('%s_%s', c_mktsegment, cast(c_nationkey as string)) AS formatted",
    ])


# ------------------------------------------------------------ sources and ingestion
def _mortality_lines(spark, d) -> DataFrame:
    cust = L.read_driver(spark, d, "customer")
    k = "c_custkey"
    rec = {e.rsplit(" AS ", 1)[1]: e.rsplit(" AS ", 1)[0] for e in L.mortality_exprs(k)}
    line = ING.format_mortality_line(*[rec[n] for n in (
        "SEQN", "ELIGSTAT", "MORTSTAT", "UCOD_LEADING", "DIABETES", "HYPERTEN", "PERMTH_INT", "PERMTH_EXM")])
    return project(cust, [f"{line} AS value", f"2003 + 2 * ({k} % 8) AS cycle"], where=f"{k} % 29 <> 0")


def src_fixed_width(spark, d):
    return ING.parse_mortality_lines(project(_mortality_lines(spark, d), ["value"]))


def _tagged_cycles(spark, d, drift: bool) -> DataFrame:
    """Every cycle's frame tagged with its loader metadata; with ``drift`` the
    education column is absent from odd cycles. Each frame reads one cycle's
    partition of the landed table, so together they read it once."""
    landed = L.landed_tables(spark, d)["demo"]
    frames = []
    for i, (start, end, sfx) in enumerate(L.CYCLES):
        cols = ["SEQN AS seqn", "cast((cast(SEQN as bigint) * 7) % 86 as double) AS ridageyr"]
        if not (drift and i % 2 == 1):
            cols.append("DMDEDUC2 AS dmdeduc2")
        raw = project(landed, cols, where=f"CYCLE_START_YEAR = {start}")
        code = ING.file_code_for("DEMO_{suffix}", sfx)
        frames.append(ING.add_common_metadata(raw, start, end, f"landing/{start}/{code}.xpt", code, "demo"))
    return ING.union_cycles(frames)


def ing_metadata(spark, d):
    """ING1 on every cycle file: upper-cased names plus the six loader constants."""
    return _tagged_cycles(spark, d, drift=False)


def ing_union_cycles(spark, d):
    """ING2: the 8 cycle frames unioned by name; odd cycles lack the education column."""
    return _tagged_cycles(spark, d, drift=True)


def ing_source_catalog(spark, d):
    """The landed catalog: every file once, from the paths of the landed files."""
    return L.landed_tables(spark, d)["source_catalog"]


def stg_source_catalog_q(spark, d):
    return _stage(spark, d)["stg_source_catalog"]


def ing_latest_release(spark, d):
    return L.landed_tables(spark, d).releases()


def ing_followup_text(spark, d):
    return L.landed_tables(spark, d).followups()


def ing_manifest(spark, d):
    return CAT.run_manifest(L.landed_tables(spark, d)["source_catalog"])


def _release_files(spark, d, release: int, where: str, path: str) -> None:
    """Fixed-width files of one release: a folder per file code, several files in each."""
    code = L.mortality_file_code("cycle", "cycle + 1", str(release))
    lines = project(_mortality_lines(spark, d), ["value", f"{code} AS file_code"], where=where)
    lines.repartition(3, "value").write.mode("append").partitionBy("file_code").text(path)


def ing_incremental(spark, d):
    """Two releases per cycle land in the wrong order, each in several files; the newest is read."""
    src, dst, ckpt = (_scratch(spark, f"mort-{x}") for x in ("src", "landed", "ckpt"))
    _release_files(spark, d, 2019, "true", src)
    run_incremental(spark, src, dst, ckpt)
    _release_files(spark, d, 2015, "cast(trim(substring(value, 1, 14)) as bigint) % 2 = 0", src)
    run_incremental(spark, src, dst, ckpt)  # older and late: kept aside
    run_incremental(spark, src, dst, ckpt)  # nothing new: a no-op
    return latest_release(spark, dst)


def ing_quarantine(spark, d):
    """Release files with cut lines, lines without a number and a stray file: every line is landed or set aside."""
    src, dst, bad, ckpt = (_scratch(spark, f"quarantine-{x}") for x in ("src", "landed", "bad", "ckpt"))
    k = "cast(trim(substring(value, 1, 14)) as bigint)"
    code = L.mortality_file_code("cycle", "cycle + 1", "2019")
    lines = project(_mortality_lines(spark, d), [
        f"CASE {k} % 50 WHEN 1 THEN substring(value, 1, 30) WHEN 2 THEN concat('x', substring(value, 2)) ELSE value END AS value",
        f"CASE WHEN {k} % 50 = 3 THEN 'notes' ELSE {code} END AS file_code"])
    lines.repartition(3, "value").write.partitionBy("file_code").text(src)
    run_quarantining(spark, src, dst, bad, ckpt)
    run_quarantining(spark, src, dst, bad, ckpt)  # nothing new: a no-op
    landed = project(latest_release(spark, dst), ["'landed' AS outcome", "format_string('%14d', cast(SEQN as bigint)) AS start_of_line"])
    aside = project(quarantined(spark, bad), ["reason AS outcome", "substring(line, 1, 14) AS start_of_line"])
    return RS.union_all_by_name([landed, aside])


def ing_load_files(spark, d):
    """The loader: release files of two years -> landing rows of each cycle's newest release."""
    src = _scratch(spark, "mort-files")
    _release_files(spark, d, 2019, "true", src)
    _release_files(spark, d, 2015, "true", src)
    landed = ING.read_mortality_files(spark, src, L.landed_tables(spark, d).releases())
    path = _scratch(spark, "mort-table")
    SNK.write_table(landed, path, ["CYCLE_START_YEAR"])
    return spark.read.schema(landed.schema).parquet(path)


# ------------------------------------------------------------ sinks
def snk_overwrite_roundtrip(spark, d):
    summary = _dag(spark, d)["validation_summary"]
    path = _scratch(spark, "summary")
    SNK.write_table(summary, path)
    SNK.write_table(summary, path)  # rerun-safe full refresh
    return spark.read.parquet(path)


def snk_range_partition(spark, d):
    cohort = _dag(spark, d)["validation_cohort"]
    cohort = project(cohort, ["*", f"{SNK.range_bucket('cycle_start_year')} AS cycle_bucket"])
    path = _scratch(spark, "cohort")
    SNK.write_table(cohort, path, partition_cols=["cycle_bucket"],
                    cluster_cols=["age_band_levine", "protein_group_day_1"])
    back = spark.read.parquet(path)
    return aggregate(back, ["cycle_bucket", "cycle_start_year", "age_band_levine", "protein_group_day_1"],
                     ["count(1) AS respondent_n"])


def snk_full_refresh_shrinks(spark, d):
    """All cycles, then only the later half: withdrawn partitions must go."""
    rows = project(L.landed_tables(spark, d)["mortality"], ["SEQN", "CYCLE_START_YEAR"])
    path = _scratch(spark, "refresh")
    SNK.write_table(rows, path, ["CYCLE_START_YEAR"])
    SNK.write_table(rows.filter("CYCLE_START_YEAR >= 2011"), path, ["CYCLE_START_YEAR"])
    return spark.read.schema("SEQN double, CYCLE_START_YEAR long").parquet(path)


def mart_build(spark, d):
    """The stored cohort, read back from its partitioned table."""
    from cohortlab.plans.queries import stored_marts
    return stored_marts(spark, d)["validation_cohort"]


def mart_bucketed_join(spark, d):
    """JN1 and M1 over the stored respondent tables: five tables meet bucket by bucket."""
    from cohortlab.plans import marts as MB
    from cohortlab.plans import models as M
    from cohortlab.plans.queries import warehouse
    wh = warehouse(spark, d)
    return M.respondent_daily({view: wh.stored(t) for view, t in MB.INPUTS.items()}, stored=True,
                              keyless=MB.keyless(wh, "keyed_demo"))


YEAR_READS = {
    "one year": [("=", 2009)], "from and before": [(">=", 2011), ("<", 2015)], "listed": [("in", [2003, 2017, 2044])],
    "all but one": [("<>", 2005)], "up to": [("<=", 2004)], "after": [(">", 2015)], "between": [("between", (2006, 2009))],
    "known": [("is not null",)],
}


def mart_pruned_read(spark, d):
    """SNK2: the stored cohort read by conditions on the year, each from its partitions alone."""
    from cohortlab.plans.queries import warehouse
    wh = warehouse(spark, d)
    return RS.union_all_by_name([
        project(wh.read("validation_cohort", *conditions), [f"{lit(name)} AS condition", KEY, "cycle_start_year", "age_years"])
        for name, conditions in YEAR_READS.items()])


def snk_compaction(spark, d):
    """SNK3: order lines added in ten increments to a clustered table, then compacted and read back."""
    from cohortlab.sinks.warehouse import Layout, Warehouse
    rows = project(_li(spark, d), ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "2003 + 2 * (l_orderkey % 4) AS y"])
    mark = uuid.uuid4().hex[:12]
    wh = Warehouse(spark, f"cohort_compact_{mark}", _scratch(spark, "compaction"), 4)
    wh.publish("lines", rows.where("l_orderkey % 10 = 0"), Layout(cluster=("l_returnflag", "l_linestatus"), year="y"))
    for part in range(1, 10):
        wh.append("lines", rows.where(f"l_orderkey % 10 = {part}"))
    wh.compact("lines")
    return wh.table("lines")


def refreshed(spark, d):
    """A clone of the marts after a second follow-up release of one cycle has landed and its cycle was rebuilt."""
    from cohortlab.plans import marts as MB
    from cohortlab.plans.queries import _memo, warehouse

    def build(landed):
        src, dst, ckpt = (_scratch(spark, f"refresh-{x}") for x in ("src", "landed", "ckpt"))
        _release_files(spark, d, 2021, "cycle = 2009 AND cast(trim(substring(value, 1, 14)) as bigint) % 5 <> 0", src)
        before = newest_releases(spark, dst)
        run_incremental(spark, src, dst, ckpt)
        years = [y for y, release in newest_releases(spark, dst).items() if before.get(y) != release]
        rows = latest_release(spark, dst).where(f"CYCLE_START_YEAR IN ({', '.join(map(str, years))})")
        code = L.mortality_file_code("CYCLE_START_YEAR", "CYCLE_END_YEAR", "MORTALITY_PUBLIC_RELEASE_YEAR")
        rows = project(rows, ["*", f"{code} AS FILE_CODE", f"concat('landing/mortality/', {code}, '.dat') AS SOURCE_URL"])
        mark = uuid.uuid4().hex[:12]
        wh = warehouse(spark, d).clone(f"cohort_refresh_{mark}", _scratch(spark, "marts-refresh"))
        MB.refresh_cycles(wh, years, {"stg_mortality": stg_mortality(rows)})
        return wh

    return _memo("refreshed", spark, d, build)


def mart_refresh_cycle(spark, d):
    """M4 after the refresh of one cycle: equal to a full rebuild with the new release."""
    return refreshed(spark, d).table("validation_cohort")


def mart_refresh_summary(spark, d):
    """M5 after the refresh, merged from the parts of all cycles."""
    return refreshed(spark, d).table("validation_summary")


def mart_refresh_trends(spark, d):
    """M6 after the refresh."""
    return refreshed(spark, d).table("cycle_protein_trends")


def flt_protein_type(spark, d):
    """FLT8 on M8 over the stored cohort."""
    from cohortlab.plans.queries import stored_marts
    return RP.protein_type_rates(RP.source_rates_long(stored_marts(spark, d)["validation_cohort"]), "Plant Protein")


# ------------------------------------------------------------ data quality
def dq_not_null(spark, d):
    return project(Q.not_null_failures(_stage(spark, d)["stg_demo"], "age_years"), [KEY, "age_years"])


def dq_unique(spark, d):
    return Q.unique_key_failures(_li(spark, d), ["l_orderkey", "l_linenumber"])


def dq_accepted_values(spark, d):
    return Q.accepted_values_failures(L.read_driver(spark, d, "events"), "event_type",
                                      ["signup", "click", "view", "purchase"])


# day totals moved by exactly the tolerance, by a little more, and not at all
SHIFT = ("CASE WHEN respondent_id % 7 = 1 THEN cast('0.1' as decimal(38,9)) "
         "WHEN respondent_id % 7 = 2 THEN cast('0.11' as decimal(38,9)) ELSE cast(0 as decimal(38,9)) END")


def _shifted(m: dict) -> dict:
    """The models with moved day totals."""
    daily = project(m["respondent_daily"], [KEY, "respondent_id", *[
        f"cast(day_{day}_protein_g as decimal(38,9)) + {SHIFT} AS day_{day}_protein_g" for day in (1, 2)]])
    return {**m, "respondent_daily": daily}


def dq_reconcile(spark, d):
    m = _shifted(_dag(spark, d))
    return RS.union_all_by_name([
        project(checks.reconciliation(m, day), [
            KEY, f"{day} AS recall_day", f"day_{day}_protein_g AS total_protein_g",
            f"day_{day}_item_protein_g AS item_protein_g"])
        for day in (1, 2)])


def _with_spoilt(spark, d):
    """The warehouse with a spoilt copy of the cohort whose tests must fail."""
    from cohortlab.plans import marts as MB
    from cohortlab.plans.queries import warehouse
    wh = warehouse(spark, d)
    if "spoilt_cohort" not in wh.layouts:
        bad = MB.spoil(wh.table("validation_cohort"))
        wh.publish("spoilt_cohort", bad, MB.layout_of("spoilt_cohort", bad.columns))
    return wh


def dq_report(spark, d):
    """All tests of the stored tables, with the counts of their writes, and of spoilt ones that must fail."""
    wh, stg = _with_spoilt(spark, d), _stage(spark, d)
    item = ["protein_item_key"]
    others = [Q.TableChecks(n, stg[n], not_null=item, unique=item) for n in ("stg_dr1iff", "stg_dr2iff")]
    others.append(Q.TableChecks("stg_source_catalog", stg["stg_source_catalog"],
                                not_null=["source_asset_key"], unique=["source_asset_key"]))
    others.append(Q.TableChecks("food_code_major_group_map", seeds.group_map(spark), not_null=["food_code_major_group"],
                                unique=["food_code_major_group"], accepted={"protein_source_group": checks.SOURCE_GROUPS}))
    daily = project(wh.stored("respondent_daily"), [
        KEY, *[f"day_{day}_protein_g" for day in (1, 2)],
        *[f"cast(day_{day}_protein_g as decimal(38,9)) + {SHIFT} AS moved_{day}" for day in (1, 2)]])
    compared = [(f"protein_item_totals_match_day_{day}", "respondent_daily", f"day_{day}_protein_g", f"day_{day}_item_protein_g") for day in (1, 2)]
    compared += [(f"shifted_totals_match_day_{day}", "spoilt_daily", f"moved_{day}", f"day_{day}_item_protein_g") for day in (1, 2)]
    return checks.stored_report(wh, others, compared, daily)


OPERATOR_QUERIES = {
    "cast_safe_int": cast_safe_int,
    "cast_safe_numeric": cast_safe_numeric,
    "cast_string": cast_string,
    "key_composite": key_composite,
    "key_item": key_item,
    "flt_boolean_3vl": flt_boolean_3vl,
    "flt_not_null": flt_not_null,
    "flt_between": flt_between,
    "flt_in_list": flt_in_list,
    "band_age": band_age,
    "band_adult_age": band_adult_age,
    "band_paper_age": band_paper_age,
    "ratio_protein_energy": ratio_protein_energy,
    "band_protein_group": band_protein_group,
    "ratio_two_day_mean": ratio_two_day_mean,
    "weight_rescale": weight_rescale,
    "band_glucose": band_glucose,
    "flag_nullable": flag_nullable,
    "food_major_group": food_major_group,
    "band_animal_bins": band_animal_bins,
    "band_plant_bins": band_plant_bins,
    "label_title_case": label_title_case,
    "join_left_star": join_left_star,
    "join_skewed_star": join_skewed_star,
    "join_left_multikey": join_left_multikey,
    "join_lookup_default": join_lookup_default,
    "agg_count": agg_count,
    "agg_sum": agg_sum,
    "agg_conditional_sum": agg_conditional_sum,
    "agg_conditional_count": agg_conditional_count,
    "agg_weighted_total": agg_weighted_total,
    "agg_weighted_conditional": agg_weighted_conditional,
    "agg_avg_nullable": agg_avg_nullable,
    "agg_weighted_rate": agg_weighted_rate,
    "reshape_pivot": reshape_pivot,
    "reshape_melt_all": reshape_melt_all,
    "reshape_melt_cols": reshape_melt_cols,
    "set_union_all": set_union_all,
    "sort_category": sort_category,
    "scalar_functions": scalar_functions,
    "src_fixed_width": src_fixed_width,
    "ing_metadata": ing_metadata,
    "ing_union_cycles": ing_union_cycles,
    "ing_source_catalog": ing_source_catalog,
    "stg_source_catalog": stg_source_catalog_q,
    "ing_latest_release": ing_latest_release,
    "ing_followup_text": ing_followup_text,
    "ing_manifest": ing_manifest,
    "ing_incremental": ing_incremental,
    "ing_load_files": ing_load_files,
    "ing_quarantine": ing_quarantine,
    "snk_overwrite_roundtrip": snk_overwrite_roundtrip,
    "snk_range_partition": snk_range_partition,
    "snk_full_refresh_shrinks": snk_full_refresh_shrinks,
    "mart_build": mart_build,
    "mart_bucketed_join": mart_bucketed_join,
    "mart_pruned_read": mart_pruned_read,
    "snk_compaction": snk_compaction,
    "mart_refresh_cycle": mart_refresh_cycle,
    "mart_refresh_summary": mart_refresh_summary,
    "mart_refresh_trends": mart_refresh_trends,
    "flt_protein_type": flt_protein_type,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_reconcile": dq_reconcile,
    "dq_report": dq_report,
}
