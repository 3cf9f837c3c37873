"""Publishing as one release, and tables written in parallel along their dependencies."""

import threading
import time

import pytest

from staffline import config as C
from staffline.config import RunConfig
from staffline.plans import concurrent, measures, monthly, report
from staffline.sources import release

from test_fixture_run import FACT, HISTORIC, PLANNED, REF

ALL_TABLES = set(C.PUBLISHED_LOOKUP_TABLES) | set(C.PUBLISHED_MEASURE_TABLES)
WITH_REPORT = ALL_TABLES | {report.NAME}


def test_a_release_is_seen_whole_or_not_at_all(spark, tmp_path):
    loc = str(tmp_path / "out")
    one, two = (spark.createDataFrame([(v,)], "x int") for v in (1, 2))
    assert release.releases(spark, loc) == [] and release.open_release(spark, loc).versions == {}
    first = release.Release(spark, loc)
    first.write("A", one)
    first.write("B", one)
    assert release.open_release(spark, loc).versions == {}
    first.commit()
    reader = release.open_release(spark, loc)
    second = release.Release(spark, loc)
    second.write("A", two)
    # written but not committed: nobody sees it
    assert release.open_release(spark, loc).table("A").collect()[0].x == 1
    second.commit()
    now = release.open_release(spark, loc)
    assert [now.table(t).collect()[0].x for t in "AB"] == [2, 1]  # B is carried over
    # a reader keeps the release that it opened; older ones can be opened by name
    assert reader.table("A").collect()[0].x == 1
    old, new = release.releases(spark, loc)
    assert release.open_release(spark, loc, old).table("A").collect()[0].x == 1 and new == now.name
    with pytest.raises(KeyError, match="no table 'C'"):
        now.table("C")


def inputs_of(spark):
    rates = spark.createDataFrame([], "date date, " + ", ".join(f"`{p}` double" for p in C.PROVIDERS))
    ref_schema = ("sheet int, maincode string, reference_sheet string, summary_detail string, staff_group string, staff_type string, "
                  "bank_agency string, workforce_kpi string, measure_detail string")
    return monthly.RunInputs(
        current=spark.createDataFrame(FACT, "maincode string, yearmonth int, value string, provider string"),
        historic=spark.createDataFrame(HISTORIC, "maincode string, yearmonth int, value string, provider string"),
        ref_long=spark.createDataFrame(REF, ref_schema),
        planned_staff=spark.createDataFrame(PLANNED, "yearmonth int, provider string, type string, plan double"),
        planned_rates=spark.createDataFrame([], "date date, yearmonth int, provider string, type string, plan double"),
        sickness_wide=rates, turnover_wide=rates)


def test_a_run_that_fails_between_two_tables_leaves_the_last_release(spark, tmp_path, monkeypatch):
    loc, cfg = str(tmp_path / "out"), RunConfig()
    monthly.run(spark, inputs_of(spark), loc, cfg)
    before = release.open_release(spark, loc)
    assert set(before.versions) == WITH_REPORT and set(before.versions.values()) == {before.name}
    assert {t: before.table(t).count() for t in ALL_TABLES} == {t: before.rows[t] for t in ALL_TABLES}
    shown = {t: sorted(map(repr, before.table(t).collect())) for t in ALL_TABLES}

    def broken(*_args):
        raise RuntimeError("plans are not there")

    with monkeypatch.context() as m:
        m.setattr(measures, "staffing_plan_all", broken)
        with pytest.raises(RuntimeError, match="plans are not there"):
            monthly.run(spark, inputs_of(spark), loc, cfg)
    after = release.open_release(spark, loc)
    assert after.versions == before.versions
    assert {t: sorted(map(repr, after.table(t).collect())) for t in ALL_TABLES} == shown
    monthly.run(spark, inputs_of(spark), loc, cfg)
    again = release.open_release(spark, loc)
    assert set(again.versions.values()) == {again.name} != {before.name}
    assert {t: sorted(map(repr, again.table(t).collect())) for t in ALL_TABLES} == shown


def test_the_run_reports_on_itself(spark, tmp_path):
    loc = str(tmp_path / "out")
    out = monthly.run(spark, inputs_of(spark), loc, RunConfig())
    assert set(out) == ALL_TABLES
    published = release.open_release(spark, loc)
    got = {}
    for r in published.table(report.NAME).collect():
        got.setdefault(r["check"], []).append((r["subject"], r["provider"], r["yearmonth"], r["rows"]))
    assert {s: n for s, _, _, n in got["rows of table"]} == {t: published.table(t).count() for t in ALL_TABLES}
    profile = {s: n for s, _, _, n in got["sheet profile"]}
    assert profile["3: Bank Staff"] == published.table("Bank_Staff").count() == 2
    assert ("Substantive Staff In Post", "OTHER", None, 1) in got["rejected provider"]
    # every key of the hand-made vacancies is single; repeat one vacancy row and the join of that month doubles
    assert "vacancy fan-out" not in got
    vacancy = out["Vacancy"].unionByName(out["Vacancy"].where("provider = 'UHB'"))
    sizes = {(r["provider"], r["yearmonth"]): (r["left_rows"], r["right_rows"], r["rows"])
             for r in report.vacancy_fan_out(out["Overall"], vacancy).collect()}
    assert sizes == {("UHB", 202404): (2, 1, 2)}
    joined = measures.vacancy_rate(out["Overall"], vacancy)
    assert joined.where("provider = 'UHB' AND yearmonth = 202404").count() == 2


def test_serial_and_parallel_runs_publish_the_same(spark, tmp_path):
    got = []
    for parallel in (1, 6):
        loc = str(tmp_path / f"out{parallel}")
        monthly.run(spark, inputs_of(spark), loc, RunConfig(), parallel=parallel)
        got.append({t: sorted(map(repr, release.open_release(spark, loc).table(t).collect())) for t in ALL_TABLES})
    assert got[0] == got[1]


def test_steps_overlap_and_follow_their_needs(spark):
    order, lock, met = [], threading.Lock(), threading.Barrier(2, timeout=30)

    def note(name, value):
        def make(done):
            if name in "ab":
                met.wait()  # only passes if both run at the same time
            with lock:
                order.append(name)
            assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == name
            return value + sum(done.get(x, 0) for x in ("a", "b"))
        return make

    steps = {"c": (("a", "b"), note("c", 100)), "a": ((), note("a", 1)), "b": ((), note("b", 2))}
    assert concurrent.run_along(spark, steps)["c"] == 103
    assert order[-1] == "c" and set(order[:2]) == {"a", "b"}
    with pytest.raises(ValueError, match="no step makes"):
        concurrent.run_along(spark, {"a": (("x",), note("a", 1))})
    with pytest.raises(ValueError, match="need each other"):
        concurrent.run_along(spark, {"x": (("y",), note("x", 1)), "y": (("x",), note("y", 1))})


def test_no_step_starts_after_a_failure(spark):
    started = []

    def fail(_done):
        time.sleep(0.1)
        raise RuntimeError("first")

    steps = {"a": ((), fail), "b": ((), lambda _d: started.append("b")), "c": (("b", "a"), lambda _d: started.append("c"))}
    with pytest.raises(RuntimeError, match="first"):
        concurrent.run_along(spark, steps, parallel=1)
    assert "c" not in started


def test_jobs_of_independent_tables_overlap(spark, tmp_path):
    """Job times of Spark's status store: writes of different tables run at the same time."""
    loc = str(tmp_path / "out")
    monthly.run(spark, inputs_of(spark), loc, RunConfig())
    jobs = spark._jsc.sc().statusStore().jobsList(None)
    spans = []
    for k in range(jobs.size()):
        job = jobs.apply(k)
        name = job.description()
        if name.isDefined() and name.get().startswith("publish ") and job.completionTime().isDefined():
            spans.append((job.submissionTime().get().getTime(), job.completionTime().get().getTime(), name.get()))
    assert any(a[2] != b[2] and a[0] < b[1] and b[0] < a[1] for a in spans for b in spans)
