"""Published tables: commits, pruning, joins by key, counted tests, refresh by cycle, names and texts."""

from __future__ import annotations

import os
import re

import pytest

from cohortlab.operators.quality import TableChecks, quality_report
from cohortlab.plans import docs
from cohortlab.plans import marts as MB
from cohortlab.plans import models as M
from cohortlab.plans.queries import dag, present, stage, stored_marts, warehouse
from cohortlab.sinks import warehouse as WH
from cohortlab.sinks.warehouse import BUCKET, Layout, Warehouse, year_predicate

YEARS = [1990, 2002, 2003, 2004, 2005, 2010, 2011, 2012, 2017, 2018, 2019, 2020, 2044, None]


@pytest.fixture
def house(spark, tmp_path):
    made = []

    def make(name="w", buckets=4):
        wh = Warehouse(spark, f"t_{name}_{len(made)}_{tmp_path.name.replace('-', '_')}", f"{tmp_path}/{name}", buckets)
        made.append(wh)
        return wh

    yield make
    for wh in made:
        wh.drop()


def by_year(spark):
    rows = [(f"k{i}_{y}", y, i) for y in YEARS for i in range(5)]
    return spark.createDataFrame(rows, "k string, y long, v long"), rows


def partitions(df):
    """Partition folders whose files a plan reads."""
    return {re.search(rf"{BUCKET}=([^/]+)/", f)[1] for f in df.inputFiles()}


def physical(spark, df):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ------------------------------------------------------------ reading by year
CONDITIONS = [(op, y) for op in ("=", "<=>", "<>", "<", "<=", ">", ">=") for y in (1990, 2003, 2004, 2010, 2018, 2019, 2044, None)] + [
    ("in", [2003, 2044, None]), ("in", []), ("between", (2004, 2011)), ("between", (2019, 2100)), ("is null", None), ("is not null", None)]


def test_pruned_reads_equal_plain_filters(spark, house):
    df, _ = by_year(spark)
    wh = house()
    wh.publish("t", df, Layout(key="k", year="y"))
    for op, value in CONDITIONS:
        text = {"in": lambda: "y IN (" + ", ".join("NULL" if v is None else str(v) for v in value) + ")" if value else "false",
                "between": lambda: f"y BETWEEN {value[0]} AND {value[1]}"}.get(op, lambda: f"y {op}" + (
                    "" if op.startswith("is") else f" {'null' if value is None else value}"))()
        want = sorted(map(tuple, df.where(text).collect()), key=str)
        got = wh.read("t", (op, value))
        assert got.columns == ["k", "y", "v"]
        assert sorted(map(tuple, got.collect()), key=str) == want, (op, value)


@pytest.mark.parametrize("condition,folders", [
    (("=", 2010), {"4"}), (("=", 1990), {"0"}), (("=", 2044), {"9"}), (("in", [2003, 2017]), {"1", "8"}),
    (("<", 2005), {"0", "1"}), ((">=", 2018), {"8", "9"}), ((">", 2018), {"9"}), (("between", (2005, 2011)), {"2", "4", "5"}),
    (("is null", None), {"__HIVE_DEFAULT_PARTITION__"}), (("<>", 2010), {"0", "1", "2", "4", "5", "8", "9"})])
def test_only_matching_partitions_are_read(spark, house, condition, folders):
    df, _ = by_year(spark)
    wh = house()
    wh.publish("t", df, Layout(key="k", year="y"))
    assert partitions(wh.read("t", condition)) == folders


def test_conditions_combine_and_mart_reads_one_partition(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    assert partitions(wh.read("validation_cohort", ("=", 2009))) == {"4"}
    assert partitions(wh.read("validation_cohort", (">=", 2011), ("<", 2015))) == {"5", "6"}
    assert year_predicate("y", ">", 2004, "b") == "(`b` >= 2 AND `y` > 2004)"


# ------------------------------------------------------------ commits
def test_a_write_that_fails_halfway_leaves_the_old_rows(spark, house):
    wh = house()
    wh.publish("t", spark.range(100).selectExpr("id AS k", "id % 9 + 2003 AS y"), Layout(key="k", year="y"))
    before = os.listdir(f"{wh.root}/t")
    broken = spark.range(0, 100_000, 1, 8).selectExpr(
        "CASE WHEN id < 99000 THEN id ELSE cast(raise_error('disk full') as bigint) END AS k", "id % 9 + 2003 AS y")
    with pytest.raises(Exception, match="disk full"):
        wh.publish("t", broken, Layout(key="k", year="y"))
    with pytest.raises(Exception, match="disk full"):
        wh.replace("t", broken, [1, 2, 3, 4, 5])
    assert wh.table("t").count() == 100
    assert os.listdir(f"{wh.root}/t") == before
    assert len(spark.sql(f"SHOW TABLES IN {wh.database}").where("NOT isTemporary").collect()) == 2  # the view and its snapshot


def test_refreshes_keep_one_superseded_snapshot(spark, house):
    wh = house()
    for n in (10, 20, 30):
        shown = wh.publish("t", spark.range(n).selectExpr("id AS k"), Layout(key="k"))
        assert shown.count() == n
    assert len(os.listdir(f"{wh.root}/t")) == 2
    spark.sql(f"SELECT count(*) FROM {wh.database}.t").collect()


def test_a_reader_that_has_begun_sees_its_snapshot(spark, house):
    wh = house()
    wh.publish("t", spark.range(10).selectExpr("id AS k"), Layout(key="k"))
    begun = wh.table("t")
    assert begun.count() == 10
    wh.publish("t", spark.range(50).selectExpr("id AS k"), Layout(key="k"))
    assert begun.count() == 10 and wh.table("t").count() == 50


# ------------------------------------------------------------ joins by key
def test_stored_models_need_no_exchange(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    inputs = {view: wh.stored(t) for view, t in MB.INPUTS.items()}
    daily, sources = wh.stored("respondent_daily"), wh.stored("protein_source_estimates")
    plans = {
        "M1": (M.respondent_daily(inputs, stored=True, keyless=False), 0),
        "M1 with rows without a key": (M.respondent_daily(inputs, stored=True), 0),
        "M3": (M.protein_source_estimates(wh.stored("protein_items")), 0),
        "M4": (M.validation_cohort(daily, sources, stored=True, keyless=False), 0),
        "M6": (M.cycle_protein_trends(daily, sources, stored=True, keyless=False), 1),
    }
    for name, (df, exchanges) in plans.items():
        plan = physical(spark, df)
        assert plan.count("Exchange") == exchanges, (name, plan)
        assert "Sort" not in plan, name
    assert MB.keyless(wh, "keyed_demo") is False


def test_stored_models_equal_the_lazy_ones(spark, sf_dir):
    lazy, stored = dag(spark, sf_dir), stored_marts(spark, sf_dir)
    for name, df in lazy.items():
        want = sorted(map(str, present(df).collect()))
        assert sorted(map(str, present(stored[name].select(*df.columns)).collect())) == want, name


def test_rows_without_a_key_bypass_the_joins(spark, house):
    """A third of the rows has no key: results are equal, and no task holds them all."""
    wh = house(buckets=8)
    fact = spark.range(0, 30_000, 1, 6).selectExpr("CASE WHEN id % 3 <> 0 THEN concat('k', id) END AS k", "id AS v", "id % 5 AS w")
    dims = [spark.range(0, 30_000, step).selectExpr("CASE WHEN id % 7 <> 0 THEN concat('k', id) END AS k", f"id * {step} AS d{step}")
            for step in (2, 3, 5)]
    wh.publish("fact", fact, Layout(key="k", not_null=("k",)))
    for i, d in enumerate(dims):
        wh.publish(f"dim{i}", d, Layout(key="k"))
    assert wh.counted("fact") == {"rows": 30_000, "not_null|k": 10_000}
    joined = WH.star_join(wh.stored("fact"), [wh.stored(f"dim{i}") for i in range(3)], "k",
                          ["d.k", "d.v", "a.d2", "b.d3", "c.d5"], "d", ["a", "b", "c"], "d.w < 4")
    plain = fact.where("w < 4")
    for d in dims:
        plain = plain.join(d, "k", "left")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.select(*joined.columns).collect()))
    # rows without a key lie in files of their own, one per task that wrote them
    loose = wh.stored("fact").where("k IS NULL").selectExpr("_metadata.file_path AS f").groupBy("f").count().collect()
    assert len(loose) == 6 and max(r["count"] for r in loose) <= 2_000
    kept = wh.stored("fact").where("k IS NOT NULL").selectExpr("_metadata.file_path AS f").distinct().count()
    assert kept == 8


def test_bucket_numbers_follow_the_size():
    assert WH.bucket_number(0) == 4 and WH.bucket_number(100 * WH.BUCKET_BYTES + 1) == 101


def test_buckets_hold_a_bounded_number_of_rows(spark, sf_dir, monkeypatch):
    """However small they are stored: a task sorts the decoded items of both days in a bucket."""
    landed = stage(spark, sf_dir).landing
    items = landed["dr1iff"].count() + landed["dr2iff"].count()

    class Chosen(Exception):
        pass

    def made(spark, database, root, buckets):
        raise Chosen(buckets)

    monkeypatch.setattr(WH, "BUCKET_ROWS", 100, raising=False)
    monkeypatch.setattr(MB, "Warehouse", made)
    with pytest.raises(Chosen) as chosen:
        MB.build_warehouse(spark, landed, {}, "unmade", "unmade")
    assert chosen.value.args[0] == -(-items // 100) > 4


# ------------------------------------------------------------ counted tests
def test_counts_of_a_write_equal_a_scan(spark, house):
    wh = house()
    df = spark.createDataFrame([(None if i % 7 == 0 else i, y, ["x", "y", "bad", "worse", None][i % 5]) for i, y in enumerate(YEARS * 6)],
                               "k long, y long, g string")
    lay = Layout(key="k", year="y", not_null=("k", "g"), accepted={"g": ["x", "y"]})

    def scanned(rows):
        return {"rows": rows.count(), "not_null|k": rows.where("k IS NULL").count(), "not_null|g": rows.where("g IS NULL").count(),
                "accepted_values|g": rows.where("g NOT IN ('x', 'y')").count()}

    wh.publish("t", df, lay)
    assert wh.counted("t") == scanned(df)
    wh.replace("t", df.where("y IN (2003, 2004) AND k > 20"), [1, 3])  # one partition shrinks, an absent one stays so
    now = df.where("coalesce(y, 0) NOT IN (2003, 2004)").unionByName(df.where("y IN (2003, 2004) AND k > 20"))
    assert sorted(map(str, wh.table("t").collect())) == sorted(map(str, now.collect()))
    assert wh.counted("t") == scanned(wh.table("t")) == scanned(now)
    wh.replace("t", df.where("1 = 0"), [None, 9])  # partitions without rows go
    assert wh.counted("t") == scanned(wh.table("t")) and wh.read("t", ("is null", None)).count() == 0
    with pytest.raises(ValueError, match="outside"):
        wh.replace("t", df.where("y = 2010"), [1])


def test_report_equals_the_scanning_report(spark, sf_dir):
    from cohortlab.plans import checks
    from cohortlab.plans.operator_queries import dq_report
    from cohortlab.sources import seeds

    got = {(r.check_name, r.model_name, r.column_name): r.failing_rows for r in dq_report(spark, sf_dir).collect()}
    stg, models = dict(stage(spark, sf_dir)), stored_marts(spark, sf_dir)
    scanned = checks.full_report(stg, models, seeds.group_map(spark))
    want = {(r.check_name, r.model_name, r.column_name): r.failing_rows for r in scanned.collect()}
    assert {k: got[k] for k in want} == want
    wrong = warehouse(spark, sf_dir).table("spoilt_cohort").where("age_band_levine LIKE 'BAND%'")
    assert got["accepted_values", "spoilt_cohort", "age_band_levine"] == wrong.select("age_band_levine").distinct().count() > 0
    assert got["shifted_totals_match_day_1", "spoilt_daily", ""] > 0


def test_report_reads_each_table_once(spark, sf_dir):
    from cohortlab.plans.operator_queries import dq_report

    plan = physical(spark, dq_report(spark, sf_dir))
    marts = [line for line in plan.splitlines() if "FileScan parquet" in line and "cohort_" in line]
    names = [re.search(r"cohort_\w+\.(\w+?)__", line)[1] for line in marts]
    twice = {"respondent_daily", "protein_source_estimates", "spoilt_cohort"}  # also reconciled; failing values listed
    assert all(names.count(n) == (2 if n in twice else 1) for n in names), names
    assert plan.count("FileScan") <= 18 and plan.count("Exchange hashpartitioning") <= 6, plan


def test_unique_report_counts_like_the_single_checks(spark, house):
    from cohortlab.operators.quality import KeyTest, unique_report

    rows = [(f"k{i % 40}" if i % 9 else None, i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, n long")
    wh = house()
    wh.publish("t", df, Layout(key="k"))
    got = {(r.model_name, r.check_name, r.column_name): r.failing_rows for r in unique_report([
        KeyTest("a", df, "k"), KeyTest("b", wh.stored("t"), "k", True), KeyTest("c", df, "n", nulls=False)]).collect()}
    one = quality_report([TableChecks("t", df, not_null=["k"], unique=["k", "n"])])
    want = {(r.check_name, r.column_name): r.failing_rows for r in one.collect()}
    assert got == {("a", "unique", "k"): want["unique", "k"], ("a", "not_null", "k"): want["not_null", "k"],
                   ("b", "unique", "k"): want["unique", "k"], ("b", "not_null", "k"): want["not_null", "k"],
                   ("c", "unique", "n"): want["unique", "n"]}


# ------------------------------------------------------------ refresh by cycle
def files(wh, name):
    """Partition -> (file, time) of the snapshot behind a table."""
    out = {}
    for f in wh.stored(name).inputFiles():
        path = f.removeprefix("file:")
        out.setdefault(re.search(rf"{BUCKET}=([^/]+)/", path)[1], set()).add((path, os.path.getmtime(path)))
    return out


def test_a_refresh_touches_one_cycle_only(spark, sf_dir, tmp_path):
    base = warehouse(spark, sf_dir)
    names = [n for n in ("keyed_mortality", "respondent_daily", "validation_cohort", "cycle_protein_trends", "validation_summary_parts",
                         "protein_items", "protein_source_estimates", "keyed_demo")]
    before = {n: files(base, n) for n in names}
    whole = {n: sorted(map(str, base.table(n).collect())) for n in names}
    wh = base.clone(f"t_clone_{tmp_path.name}", str(tmp_path / "clone"))
    assert {n: files(wh, n) for n in names} == before  # a clone shares all files
    rows = stage(spark, sf_dir)["stg_mortality"].where("cycle_start_year = 2013 AND respondent_id % 3 = 0")
    rebuilt = MB.refresh_cycles(wh, [2013], {"stg_mortality": rows})
    assert rebuilt == ["respondent_daily", "validation_cohort", "cycle_protein_trends", "validation_summary_parts", "validation_summary"]
    touched = {"keyed_mortality", "respondent_daily", "validation_cohort", "cycle_protein_trends", "validation_summary_parts"}
    for n in names:
        after = files(wh, n)
        assert {k: v for k, v in after.items() if k != "6"} == {k: v for k, v in before[n].items() if k != "6"}, n
        assert (after["6"] != before[n]["6"]) == (n in touched), n
    assert {n: sorted(map(str, base.table(n).collect())) for n in names} == whole  # the original is as it was
    # the same as a full rebuild
    stg = dict(stage(spark, sf_dir))
    stg["stg_mortality"] = stg["stg_mortality"].where("cycle_start_year <> 2013 OR respondent_id % 3 = 0")
    full = M.build_all(spark, stg)
    for n in ("respondent_daily", "validation_cohort", "validation_summary", "cycle_protein_trends"):
        want = sorted(map(str, present(full[n]).collect()))
        assert sorted(map(str, present(wh.table(n).select(*full[n].columns)).collect())) == want, n
    wh.drop()


def test_changed_foods_rebuild_their_own_models(spark, sf_dir, tmp_path):
    wh = warehouse(spark, sf_dir).clone(f"t_items_{tmp_path.name}", str(tmp_path / "items"))
    stg = dict(stage(spark, sf_dir))
    days = {v: stg[v].where("cycle_start_year = 2005 AND food_line_number % 2 = 0") for v in ("stg_dr1iff", "stg_dr2iff")}
    assert MB.refresh_cycles(wh, [2005], {}, days) == [
        "protein_items", "protein_source_estimates", "validation_cohort", "cycle_protein_trends", "validation_summary_parts",
        "validation_summary"]
    for v in days:
        stg[v] = stg[v].where("cycle_start_year <> 2005 OR food_line_number % 2 = 0")
    full = M.build_all(spark, stg)
    for n in ("protein_source_estimates", "validation_cohort", "validation_summary"):
        want = sorted(map(str, present(full[n]).collect()))
        assert sorted(map(str, present(wh.table(n).select(*full[n].columns)).collect())) == want, n
    wh.drop()


def test_cycles_of_an_overflow_bucket_are_kept(spark, house, sf_dir):
    """Two cycles beyond the range share a bucket; refreshing one keeps the other."""
    stg = dict(stage(spark, sf_dir))
    later = "CASE WHEN cycle_start_year = 2015 THEN 2021 WHEN cycle_start_year = 2017 THEN 2023 ELSE cycle_start_year END"
    wh = house()
    moved = {}
    for view, table in MB.INPUTS.items():
        cols = [f"{later} AS cycle_start_year" if c == "cycle_start_year" else c for c in stg[view].columns]
        moved[view] = stg[view].selectExpr(*cols)
        wh.publish(table, moved[view], MB.layout_of(table, moved[view].columns))
    wh.publish("respondent_daily", M.respondent_daily({v: wh.stored(t) for v, t in MB.INPUTS.items()}, stored=True),
               MB.layout_of("respondent_daily", dag(spark, sf_dir)["respondent_daily"].columns), True)
    n = wh.table("respondent_daily").where("cycle_start_year = 2023").count()
    rows = moved["stg_mortality"].where("cycle_start_year = 2021 AND respondent_id % 3 = 0")
    names, MB.READS = MB.READS, {"respondent_daily": MB.READS["respondent_daily"]}
    try:
        MB.refresh_cycles(wh, [2021], {"stg_mortality": rows})
    finally:
        MB.READS = names
    assert n > 0 and wh.table("respondent_daily").where("cycle_start_year = 2023").count() == n
    assert wh.table("keyed_mortality").where("cycle_start_year = 2021").count() == rows.count()


# ------------------------------------------------------------ increments and upkeep
def row_groups(wh, name, band, grp):
    """(row groups, those whose statistics may hold rows of (band, grp)) of a table's files."""
    import pyarrow.parquet as pq

    every = may = 0
    for files in wh.files(name).values():
        for f in files:
            meta = pq.ParquetFile(f.removeprefix("file:")).metadata
            for g in range(meta.num_row_groups):
                cols = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
                every += 1
                may += all(cols[c].min <= v <= cols[c].max for c, v in (("band", band), ("grp", grp)))
    return every, may


def test_ten_increments_and_compaction(spark, house):
    wh = house()
    rows = spark.range(40_000).selectExpr("id AS v", "concat('b', id % 3) AS band", "concat('g', cast(id / 3 as bigint) % 3) AS grp",
                                          "CASE WHEN id % 500 = 73 THEN NULL WHEN cast(id / 10 as bigint) % 2 = 0 THEN 2003 ELSE 2009 END AS y")
    lay = Layout(cluster=("band", "grp"), year="y", not_null=("y",), row_group_bytes=8 << 10)
    wh.publish("t", rows.where("v % 10 = 0"), lay)
    for i in range(1, 10):
        wh.append("t", rows.where(f"v % 10 = {i}"))
    crowded = {b: len(f) for b, f in wh.files("t").items()}
    before = row_groups(wh, "t", "b1", "g1")
    assert max(crowded.values()) > 8
    assert wh.counted("t") == {"rows": 40_000, "not_null|y": 80}
    small = {b: f for b, f in wh.files("t").items() if len(f) <= 8}
    done = wh.compact("t", 8)
    after = wh.files("t")
    assert set(done) == {b for b, n in crowded.items() if n > 8} and all(len(f) <= 8 for f in after.values())
    assert {b: after[b] for b in small} == small  # partitions with few files are not rewritten
    assert sorted(map(str, wh.table("t").collect())) == sorted(map(str, rows.collect()))
    assert wh.counted("t") == {"rows": 40_000, "not_null|y": rows.where("y IS NULL").count()}
    every, may = row_groups(wh, "t", "b1", "g1")
    assert every > 12 and 3 * may < every and before[1] * 2 > before[0], (before, (every, may))
    assert wh.compact("t", 8) == []


def test_increments_of_keyed_tables(spark, house, tmp_path):
    wh = house()
    rows = spark.range(4_000).selectExpr("concat('k', id) AS k", "2003 + 2 * (id % 3) AS y")
    wh.publish("t", rows.where("substring(k, -1, 1) = '0'"), Layout(key="k", year="y", not_null=("k",)))
    for i in range(1, 10):
        wh.append("t", rows.where(f"substring(k, -1, 1) = '{i}'"))
    assert sorted(wh.compact("t")) == [1, 2, 3] and all(len(f) <= wh.buckets for f in wh.files("t").values())
    assert wh.table("t").count() == 4_000 == wh.counted("t")["rows"]
    plan = physical(spark, wh.stored("t").groupBy("k").count())
    assert "Exchange" not in plan
    wh.clone(f"t_shared_{tmp_path.name}", str(tmp_path / "shared"))
    with pytest.raises(ValueError, match="clone"):
        wh.append("t", rows)
    wh.publish("flat", rows.select("k"), Layout(key="k"))
    with pytest.raises(ValueError, match="no partitions"):
        wh.compact("flat")


# ------------------------------------------------------------ names and texts
def test_every_published_column_has_its_text(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    for name in wh.layouts:
        rows = spark.sql(f"DESCRIBE {wh.database}.{name}").collect()
        assert [r["col_name"] for r in rows] == wh.table(name).columns
        assert all(r["comment"] == docs.column_text(r["col_name"]) and r["comment"] for r in rows), name
        assert spark.catalog.getTable(f"{wh.database}.{name}").description == docs.TABLES[name]


def test_staging_views_and_reports_by_name(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    for view, df in stage(spark, sf_dir).items():
        assert sorted(map(str, spark.table(f"{wh.database}.{view}").collect())) == sorted(map(str, df.collect())), view
    got = spark.sql(f"SELECT age_band_levine, count(*) AS n FROM {wh.database}.validation_cohort GROUP BY 1").collect()
    assert sum(r["n"] for r in got) == dag(spark, sf_dir)["validation_cohort"].count()


def test_folders_have_databases_of_their_own(spark, house):
    one, two = house("a"), house("b")
    one.publish("t", spark.range(3).selectExpr("id AS k"), Layout(key="k", comment="it's one", columns={"k": "the key's text"}))
    two.publish("t", spark.range(5).selectExpr("id AS k"), Layout(key="k"))
    assert one.database != two.database and one.table("t").count() == 3 and two.table("t").count() == 5
    assert spark.catalog.getTable(f"{one.database}.t").description == "it's one"
    assert spark.sql(f"DESCRIBE {one.database}.t").first()["comment"] == "the key's text"
    with pytest.raises(KeyError, match="without a text"):
        docs.column_texts(["respondent_key", "no_such_column"])
