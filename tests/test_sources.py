"""Landing sources: XPT decode, fixed-width mortality, loader metadata, catalog text."""

from __future__ import annotations

import io
import json

import pandas as pd
from helpers import rows
from xpt_builder import build_xpt

from cohortlab.functions.sql import project
from cohortlab.sources import catalog as CAT
from cohortlab.sources import ingest as ING
from cohortlab.sources.xpt import read_xpt, read_xpt_asset


def test_xpt_builder_is_readable_by_pandas():
    raw = build_xpt(["SEQN", "AGE"], [(1.0, 50.0), (2.0, None), (3.0, 0.0)])
    df = pd.read_sas(io.BytesIO(raw), format="xport")
    assert list(df.columns) == ["SEQN", "AGE"]
    assert df["SEQN"].tolist() == [1.0, 2.0, 3.0]


def test_xpt_files_decode_with_drift_missing_and_zero(spark, tmp_path):
    d = tmp_path / "xpt"
    d.mkdir()
    (d / "DEMO_C.xpt").write_bytes(build_xpt(["SEQN", "RIDAGEYR", "DMDEDUC2"], [(1.0, 50.5, 3.0), (2.0, None, 0.0)]))
    (d / "DEMO_D.XPT").write_bytes(build_xpt(["seqn", "RIDAGEYR"], [(3.0, 70.0)]))  # no education, lower case
    (d / "notes.txt").write_text("ignored")
    got = rows(read_xpt_asset(spark, str(d), "demo", ["SEQN", "RIDAGEYR", "DMDEDUC2"]), ["SEQN"])
    assert [(r["SEQN"], r["RIDAGEYR"], r["DMDEDUC2"]) for r in got] == [(1.0, 50.5, 3.0), (2.0, None, 0.0),
                                                                        (3.0, 70.0, None)]
    assert [(r["CYCLE_START_YEAR"], r["CYCLE_LABEL"], r["FILE_CODE"]) for r in got] == [
        (2003, "2003-2004", "DEMO_C"), (2003, "2003-2004", "DEMO_C"), (2005, "2005-2006", "DEMO_D")]
    assert all(r["ASSET_TYPE"] == "demo" for r in got)


def test_xpt_zero_is_repaired(spark, tmp_path):
    raw = build_xpt(["X"], [(0.0,), (None,), (2.0,)])
    # the pandas reader turns a stored zero into a tiny positive number
    assert 0 < pd.read_sas(io.BytesIO(raw), format="xport")["X"][0] < 1e-70
    (tmp_path / "A_C.xpt").write_bytes(raw)
    vals = [r.X for r in read_xpt(spark, str(tmp_path), ["X"]).collect()]
    assert sorted(vals, key=lambda v: (v is None, v)) == [0.0, 2.0, None]


def _line(seqn, elig, mort, ucod, diab, hyp, pint, pexm):
    out = seqn.rjust(14) + elig + mort + ucod.ljust(3) + diab + hyp + " " * 21 + pint.rjust(3) + pexm.rjust(3)
    assert len(out) == 48
    return out


def test_fixed_width_edges(spark):
    lines = [
        _line("21005", "1", "1", "002", "1", "0", "120", "119"),   # full record
        _line("21006", "1", "0", ".", ".", "0", ".", "999"),       # '.' cause stays text, '.' numerics NULL
        _line("21007", "1", "0", "", "0", "0", "10", "9"),         # blank cause -> NULL
        "   ",                                                      # blank line skipped
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = rows(ING.parse_mortality_lines(df), ["SEQN"])
    assert len(got) == 3
    a, b, c = got
    assert (a["SEQN"], a["ELIGSTAT"], a["MORTSTAT"], a["UCOD_LEADING"], a["DIABETES"], a["HYPERTEN"],
            a["PERMTH_INT"], a["PERMTH_EXM"]) == (21005.0, 1.0, 1.0, "002", 1.0, 0.0, 120.0, 119.0)
    assert b["UCOD_LEADING"] == "." and b["DIABETES"] is None and b["PERMTH_INT"] is None
    assert b["PERMTH_EXM"] == 999.0
    assert c["UCOD_LEADING"] is None and c["PERMTH_INT"] == 10.0


def test_fixed_width_roundtrip_through_files(spark, tmp_path):
    exprs = ING.format_mortality_line("s", "e", "m", "u", "d", "h", "pi", "pe")
    src = spark.createDataFrame([(7.0, 1.0, 1.0, "005", 0.0, 1.0, 12.0, 11.0), (8.0, 2.0, None, None, None, None, 3.0, 2.0)],
                                "s double, e double, m double, u string, d double, h double, pi double, pe double")
    lines = project(src, [f"{exprs} AS value"])
    assert all(len(r.value) == ING.MORTALITY_LINE_WIDTH for r in lines.collect())
    folder = tmp_path / "SURVEY_2003_2004_MORT_2019_PUBLIC.dat"
    lines.write.mode("overwrite").text(str(folder))
    (tmp_path / "readme.dat").write_text("no record")
    got = rows(ING.read_mortality_files(spark, str(tmp_path)), ["SEQN"])
    assert {(r["CYCLE_LABEL"], r["FILE_CODE"], r["MORTALITY_PUBLIC_RELEASE_YEAR"]) for r in got} == {
        ("2003-2004", "SURVEY_2003_2004_MORT_2019_PUBLIC", 2019)}
    assert [(r["SEQN"], r["MORTSTAT"], r["UCOD_LEADING"], r["PERMTH_EXM"]) for r in got] == [
        (7.0, 1.0, "005", 11.0), (8.0, None, None, 2.0)]


def test_common_metadata_and_union_with_drift(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "seqn double, dmdeduc2 double")
    b = spark.createDataFrame([(3.0,)], "Seqn double")
    fa = ING.add_common_metadata(a, 2003, 2004, "landing/2003/DEMO_C.xpt", "DEMO_C", "demo")
    fb = ING.add_common_metadata(b, 2005, 2006, "landing/2005/DEMO_D.xpt", "DEMO_D", "demo")
    u = ING.union_cycles([fa, fb])
    assert u.columns[:2] == ["SEQN", "DMDEDUC2"]
    got = rows(u, ["SEQN"])
    assert got[1]["DMDEDUC2"] is None and got[1]["CYCLE_LABEL"] == "2005-2006"
    assert ING.file_code_for("GLU_{suffix}", "C", {"C": "L10AM_C"}) == "L10AM_C"
    assert ING.file_code_for("GLU_{suffix}", "D", {"C": "L10AM_C"}) == "GLU_D"


def test_latest_release_and_missing_release(spark):
    listing = spark.createDataFrame([
        ("<a>SURVEY_2003_2004_MORT_2011_PUBLIC.dat</a> <a>SURVEY_2003_2004_MORT_2019_PUBLIC.dat</a>",),
        ("SURVEY_2005_2006_MORT_2015_PUBLIC.dat and SURVEY_2005_2006_MORT_2019_PUBLIC.dat",),
        ("nothing here",)], "txt string")
    got = {(r.cycle_start_year, r.latest_release_year) for r in CAT.latest_release_years(listing, "txt").collect()}
    assert got == {(2003, 2019), (2005, 2019)}
    per_row = listing.selectExpr(CAT.latest_release_for_cycle("txt", 2003, 2004)).collect()
    assert [r[0] for r in per_row] == [2019, None, None]


def test_followup_text(spark):
    df = spark.createDataFrame([
        ("Files UPDATED with mortality follow-up data through December 31, 2019. More.",),
        ("no sentence",)], "t string")
    assert [r[0] for r in df.selectExpr(CAT.followup_text("t")).collect()] == ["December 31, 2019", None]


def test_manifest_from_landed_catalog(spark, sf_dir):
    from cohortlab.sources.landing import landed_tables

    releases = spark.createDataFrame([(y, 2019) for y in range(2003, 2019, 2)], "cycle_start_year long, latest_release_year long")
    followup = spark.createDataFrame([("December 31, 2019",), (None,)], "followup_through string")
    cat = CAT.source_catalog(landed_tables(spark, sf_dir).files(), releases, followup)
    assert cat.count() == 56
    doc = json.loads(CAT.run_manifest(cat).first()[0])
    assert doc["cycles"][0] == "2003-2004" and len(doc["cycles"]) == 8
    assert doc["survey_assets"] == ["demo", "dr1iff", "dr1tot", "dr2iff", "dr2tot", "glu"]
    assert set(doc["public_mortality_release_year_by_cycle"].values()) == {2019}
    assert doc["mortality_followup_available_through"] == "December 31, 2019"
    assert doc["linked_mortality_note"] and doc["paper_comparability_note"] and len(doc) == 7


def test_catalog_lists_files_without_reading_rows(spark, sf_dir, tmp_path):
    """A cycle of one asset without rows is still a file; the listing opens none."""
    from cohortlab.sources import landing as L

    class Fewer(L.Landed):
        def _derived(self, name):
            df = super()._derived(name)
            return df.where("CYCLE_START_YEAR <> 2011") if name == "glu" else df

    landed = Fewer(spark, sf_dir, str(tmp_path / "landing"))
    cat = landed["source_catalog"]
    assert cat.count() == 56 and len(landed) == 8
    empty = cat.where("asset_type = 'glu' AND cycle_start_year = 2011").collect()
    assert [(r.file_code, r.cycle_label, r.source_url) for r in empty] == [("GLU_G", "2011-2012", "landing/2011/GLU_G.xpt")]
    assert landed["glu"].where("CYCLE_START_YEAR = 2011").count() == 0
    assert sorted(r.file_code for r in cat.where("cycle_start_year = 2003").collect()) == sorted(
        code for a in L.ASSETS for y, code in L.file_codes(a) if y == 2003)
    plan = landed.files()._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("scan") == 1 and "binaryfile" in plan.lower() and "ReadSchema: struct<path:string>" in plan


def test_landing_moves_narrow_rows(spark, sf_dir, tmp_path):
    """Rows are dealt by cycle before they are widened, by every table, and files are packed with zstd."""
    from cohortlab.sources import landing as L

    written = {}

    class Noted(L.Landed):
        def _write(self, name, df, *partitions):
            written[name] = df
            super()._write(name, df, *partitions)

    landed = Noted(spark, sf_dir, str(tmp_path / "landing"))
    for name in L.ASSETS:
        landed[name]

    def dealt(plan):
        below = [plan.children().apply(i) for i in range(plan.children().size())]
        found = [p.output().size() for p in [plan] if p.nodeName() == "RebalancePartitions"]
        return found + [n for p in below for n in dealt(p)]

    for name in L.ASSETS:
        moved = dealt(written[name]._jdf.queryExecution().optimizedPlan())
        assert len(moved) == 1 and moved[0] <= 7 < len(written[name].columns), (name, moved)
        assert sum(f.endswith(".zstd.parquet") for f in landed[name].inputFiles()) >= 8


def test_group_map_csv_reads_with_declared_schema(spark, tmp_path):
    from cohortlab.operators.quality import TableChecks, quality_report
    from cohortlab.sources import seeds

    path = tmp_path / "map.csv"
    lines = ["food_code_major_group,major_group_label,protein_source_group,classification_method,classification_notes"]
    lines += [",".join([str(r[0]), *[f'"{v}"' for v in r[1:]]]) for r in seeds.GROUP_MAP_ROWS]
    path.write_text("\n".join(lines) + "\n")
    df = seeds.read_group_map_csv(spark, str(path))
    assert str(df.schema["food_code_major_group"].dataType) == "LongType()"
    assert rows(df, ["food_code_major_group"]) == rows(seeds.group_map(spark), ["food_code_major_group"])
    rep = quality_report([TableChecks("seed", df, not_null=["food_code_major_group"],
                                      unique=["food_code_major_group"],
                                      accepted={"protein_source_group": ["animal", "plant", "unclassified"]})])
    assert all(r.passed for r in rep.collect())
