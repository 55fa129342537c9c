"""Incremental landing: reruns change nothing, releases and files never replace one another wrongly."""

from __future__ import annotations

from cohortlab.streaming.incremental import (
    latest_release, newest_releases, quarantined, run_incremental, run_quarantining,
)


def _line(seqn: int, mort: str = "0") -> str:
    return str(seqn).rjust(14) + "1" + mort + "   " + "00" + " " * 21 + " 12" + " 11"


def _write(path, seqns, mort="0"):
    with open(path, "w") as f:
        f.write("\n".join(_line(s, mort) for s in seqns) + "\n")


def _seen(spark, dst):
    return {(r.CYCLE_START_YEAR, r.SEQN, r.MORTALITY_PUBLIC_RELEASE_YEAR) for r in latest_release(spark, dst).collect()}


def test_rerun_is_a_noop_and_a_new_release_replaces_its_cycle(spark, tmp_path):
    src, dst, ckpt = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "ckpt")
    src.mkdir()
    _write(src / "SURVEY_2003_2004_MORT_2015_PUBLIC.dat", [1, 2, 3])
    _write(src / "SURVEY_2005_2006_MORT_2015_PUBLIC.dat", [4, 5])
    assert run_incremental(spark, str(src), dst, ckpt) == 5
    assert run_incremental(spark, str(src), dst, ckpt) == 0
    _write(src / "SURVEY_2003_2004_MORT_2019_PUBLIC.dat", [1, 2, 3, 6], mort="1")
    assert run_incremental(spark, str(src), dst, ckpt) == 4
    assert _seen(spark, dst) == {(2003, float(s), 2019) for s in (1, 2, 3, 6)} | {(2005, 4.0, 2015), (2005, 5.0, 2015)}


def test_late_older_release_and_second_file(spark, tmp_path):
    src, dst, ckpt = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "ckpt")
    (src / "SURVEY_2007_2008_MORT_2019_PUBLIC.dat").mkdir(parents=True)  # a release in two files
    _write(src / "SURVEY_2007_2008_MORT_2019_PUBLIC.dat" / "part-0", [7, 8])
    run_incremental(spark, str(src), dst, ckpt)
    _write(src / "SURVEY_2007_2008_MORT_2011_PUBLIC.dat", [7])
    _write(src / "SURVEY_2007_2008_MORT_2019_PUBLIC.dat" / "part-1", [9])
    run_incremental(spark, str(src), dst, ckpt)
    assert _seen(spark, dst) == {(2007, 7.0, 2019), (2007, 8.0, 2019), (2007, 9.0, 2019)}


def test_stray_names_are_skipped(spark, tmp_path):
    src, dst, ckpt = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "ckpt")
    src.mkdir()
    _write(src / "SURVEY_2003_2004_MORT_2015_PUBLIC.dat", [1])
    _write(src / "readme.dat", [99])
    assert run_incremental(spark, str(src), dst, ckpt, glob="*.dat") == 1
    assert _seen(spark, dst) == {(2003, 1.0, 2015)}


def test_lines_that_cannot_be_landed_are_set_aside(spark, tmp_path):
    src, dst, bad, ckpt = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "bad"), str(tmp_path / "ckpt")
    src.mkdir()
    good = src / "SURVEY_2003_2004_MORT_2015_PUBLIC.dat"
    good.write_text("\n".join([_line(1), _line(2)[:20], "", "   ", "abc".rjust(14) + _line(3)[14:], _line(4) + "9"]) + "\n")
    _write(src / "readme.dat", [99])
    assert run_quarantining(spark, str(src), dst, bad, ckpt) == {"landed": 1, "quarantined": 4}
    seen = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in quarantined(spark, bad).collect())
    assert seen == sorted([(good.name, _line(2)[:20], "line width"), (good.name, _line(4) + "9", "line width"),
                           (good.name, "abc".rjust(14) + _line(3)[14:], "respondent number"), ("readme.dat", _line(99), "file name")])
    assert _seen(spark, dst) == {(2003, 1.0, 2015)}
    assert run_quarantining(spark, str(src), dst, bad, ckpt) == {"landed": 0, "quarantined": 0}
    _write(src / "SURVEY_2005_2006_MORT_2019_PUBLIC.dat", [5])
    assert run_quarantining(spark, str(src), dst, bad, ckpt) == {"landed": 1, "quarantined": 0}
    assert newest_releases(spark, dst) == {2003: 2015, 2005: 2019} and newest_releases(spark, str(tmp_path / "none")) == {}
    # without the first checkpoint everything is read again, and nothing is doubled
    assert run_quarantining(spark, str(src), dst, bad, str(tmp_path / "again")) == {"landed": 2, "quarantined": 4}
    assert quarantined(spark, bad).count() == 4 and latest_release(spark, dst).count() == 2
