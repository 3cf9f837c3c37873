"""Literal end-to-end run on a hand-made fixture in the original labels.

Every expected number below is worked out by hand from the fixture rows.
"""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from staffline import config as C
from staffline.config import RunConfig
from staffline.plans import monthly

CFG = RunConfig(grid_first_period=202404, grid_last_period=202408, latest_month=202407, load_date="2024-08-05")
SYS = C.SYSTEM_TOTAL_LABEL

REF = [
    # sheet, maincode, reference_sheet, summary_detail, staff_group, staff_type, bank_agency, workforce_kpi, measure
    (1, "S1", "Overall", C.SUBSTANTIVE_WTE, None, None, None, None, None),
    (1, "S2", "Overall", C.ALL_STAFF_WTE, None, None, None, None, None),
    (1, "S3", "Overall", C.AGENCY_WTE, None, None, None, None, None),
    (1, "S4", "Overall", C.BANK_WTE, None, None, None, None, None),
    (2, "G1", "Staff Group", None, C.NURSING_GROUP, "Total", None, None, None),
    (2, "G2", "Staff Group", None, "Obs & Gynae", "Total", None, None, None),
    (2, None, "Staff Group", None, "Medical and dental", "Total", None, None, None),
    (3, "B1", "Bank Staff", None, "Clinical Support", "Total", "Bank", None, None),
    (3, "B1", "Bank Staff", None, "Clinical Support", "Total", "Bank", None, None),
    (4, "A1", "Agency Staff", None, "Clinical Support", "Total", "Agency", None, None),
    (5, "K1", "KPI", None, None, None, None, C.TURNOVER_KPI, None),
    (5, "K2", "KPI", None, None, None, None, None, None),
    (5, "K3", "KPI", None, None, None, None, "Appraisal %", None),
    (6, "V1", "Vacancy", None, C.ALL_ROLES, "Total", None, None, None),
    (6, "V2", "Vacancy", None, C.NURSING_GROUP, "Total", None, None, None),
    (6, "V3", "Vacancy", None, None, "Total", None, None, None),
    (12, "H1", "HCSW", None, None, None, None, None, C.HCSW_RATE_MEASURES[0]),
    (12, "H2", "HCSW", None, None, None, None, None, None),
]
REF_SCHEMA = ("sheet int, maincode string, reference_sheet string, summary_detail string, staff_group string, "
              "staff_type string, bank_agency string, workforce_kpi string, measure_detail string")

FACT = [
    # maincode, yearmonth, value, provider
    ("S1", 202404, "100", "UHB"), ("V1", 202404, "-10", "UHB"),      # vacancy made positive
    ("S1", 202404, "0", "ROH"), ("V1", 202404, "0", "ROH"),          # 0/0 rate -> NULL
    ("S2", 202404, "150", "UHB"), ("S2", 202404, "n/a", "ROH"),      # bad text -> 0
    ("G1", 202404, "40", "UHB"), ("V2", 202404, "4", "UHB"),
    ("G2", 202404, "7", "UHB"),                                      # Obs & Gynae excluded from metric 9
    (None, 202404, "9", "UHB"),                                      # NULL code matches NULL code
    ("B1", 202404, "3", "UHB"),                                      # doubled by the code list
    ("A1", 202404, "2", "UHB"),
    ("S3", 202404, "5", "UHB"), ("S3", 202405, "0", "UHB"),
    ("K1", 202404, "1", "UHB"), ("K2", 202404, "2", "UHB"), ("K3", 202404, "3", "UHB"),
    ("H1", 202404, "0.1", "UHB"), ("H1", 202408, "0.2", "UHB"), ("H2", 202408, "5", "UHB"),
    ("S1", 202404, "999", "OTHER"),                                  # provider outside the grid
    ("S1", 202408, "120", "UHB"),                                    # after the cut-off
]
HISTORIC = [("S1", 202403, "90", "UHB")]
PLANNED = [
    # yearmonth, provider, type, plan
    (202404, "UHB", C.SUBSTANTIVE_PLAN, 105.0),
    (202405, "UHB", C.SUBSTANTIVE_PLAN, 106.0),                        # plan without actual
    (202404, "ROH", C.SUBSTANTIVE_PLAN, None),                         # poisons the system plan
    (202404, "UHB", C.AGENCY_PLAN, 0.0),                               # actual 5 -> +Inf
    (202405, "UHB", C.AGENCY_PLAN, 0.0),                               # actual 0 -> NaN -> NULL
]


def _rates(spark, values):
    cols = ", ".join(f"{p} double" for p in C.PROVIDERS)
    return spark.createDataFrame(values, f"date date, {cols}")


def _inputs(spark):
    d = dt.date
    sick = _rates(spark, [(d(2024, 4, 1), 0.05, None, 0.0, 0.04, 0.03), (d(2024, 8, 1), 0.06, 0.0, 0.0, 0.0, 0.0)])
    turn = _rates(spark, [(d(2024, 4, 1), 0.10, None, 0.12, 0.11, 0.09)])
    planned_rates = spark.createDataFrame(
        [(d(2024, 4, 1), 202404, "UHB", C.SICKNESS_SHEET, 0.04), (d(2024, 4, 1), 202404, "ROH", C.SICKNESS_SHEET, 0.0)],
        "date date, yearmonth int, provider string, type string, plan double")
    inputs = monthly.RunInputs(
        current=spark.createDataFrame(FACT, "maincode string, yearmonth int, value string, provider string")
        .withColumn("load_date", F.lit(CFG.load_date).cast("date")),
        historic=spark.createDataFrame(HISTORIC, "maincode string, yearmonth int, value string, provider string"),
        ref_long=spark.createDataFrame(REF, REF_SCHEMA),
        planned_staff=spark.createDataFrame(PLANNED, "yearmonth int, provider string, type string, plan double"),
        planned_rates=planned_rates, sickness_wide=sick, turnover_wide=turn)
    return inputs


@pytest.fixture(scope="module")
def out(spark):
    return monthly.compute(spark, _inputs(spark), CFG)


def test_published_run_equals_lazy_run(spark, out):
    import tempfile
    published = monthly.run(spark, _inputs(spark), tempfile.mkdtemp(prefix="staffline-run-"), CFG)
    assert set(published) == set(C.PUBLISHED_LOOKUP_TABLES) | set(C.PUBLISHED_MEASURE_TABLES)
    for name in ("Main_Overview", "Staffing_Actual_Plan", "KPI", "HCSW", "Vacancy_Rate_Calc"):
        a, b = published[name], out[name]
        assert sorted(a.columns) == sorted(b.columns)
        cols = sorted(a.columns)
        assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def _find(df, **eq):
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.col(k).isNull() if v is None else (F.col(k) == v))
    return df.filter(cond).collect()


def test_lookup_tables(out):
    assert len(_find(out["Staff_Group"], maincode=None)) == 1                 # N1
    assert [r.value for r in _find(out["Vacancy"], maincode="V1", provider="UHB")] == [10.0]  # X4
    assert [r.value for r in _find(out["Overall"], maincode="S2", provider="ROH")] == [0.0]   # N8
    assert len(_find(out["Bank_Staff"], maincode="B1")) == 2                  # N13
    assert out["Bank_Agency"].count() == 3
    assert len(_find(out["Overall"], yearmonth=202403)) == 1                  # historic kept


def test_vacancy_rates(out):
    v = out["Vacancy_Rate_Calc"]
    uhb = _find(v, provider="UHB", yearmonth=202404, type=C.MAIN_VACANCY)[0]
    assert (uhb.vacancy, uhb.substantive, uhb.total) == (10.0, 100.0, 110.0)
    assert uhb.rate == pytest.approx(10 / 110)
    assert _find(v, provider="ROH", yearmonth=202404, type=C.MAIN_VACANCY)[0].rate is None   # 0/0 -> NULL
    sysrow = _find(v, provider=SYS, yearmonth=202404, type=C.MAIN_VACANCY)[0]
    # the system total sums every provider in the fact, also those outside the grid list
    assert (sysrow.vacancy, sysrow.substantive) == (10.0, 100.0 + 0.0 + 999.0)
    nurse = _find(v, provider="UHB", type=C.NURSING_VACANCY)[0]
    assert nurse.rate == pytest.approx(4 / 44)


def test_staffing_plan(out):
    s = out["Staffing_Actual_Plan"]
    main = _find(s, provider="UHB", yearmonth=202404, type=C.STAFFING_VS_PLAN_SUBSTANTIVE)[0]
    assert (main.substantive, main.plan, main.difference_wte) == (100.0, 105.0, -5.0)
    assert main.vacancy_rate == pytest.approx(10 / 110)
    only_plan = _find(s, provider="UHB", yearmonth=202405, type=C.STAFFING_VS_PLAN_SUBSTANTIVE)[0]
    assert only_plan.substantive is None and only_plan.plan == 106.0                        # J3
    only_actual = _find(s, provider="ROH", yearmonth=202404, type=C.STAFFING_VS_PLAN_SUBSTANTIVE)[0]
    assert only_actual.plan is None and only_actual.substantive == 0.0
    sys_plan = _find(s, provider=SYS, yearmonth=202404, type=C.STAFFING_VS_PLAN_SUBSTANTIVE)[0]
    assert sys_plan.plan is None                                                              # N4
    inf = _find(s, provider="UHB", yearmonth=202404, type=C.AGENCY_ACTUAL_VS_PLAN)[0]
    assert inf.percentage_difference == math.inf                                              # N6
    nan = _find(s, provider="UHB", yearmonth=202405, type=C.AGENCY_ACTUAL_VS_PLAN)[0]
    assert nan.percentage_difference is None                                                  # N7
    assert not _find(s, yearmonth=202408)


def test_kpi_override(out):
    k = out["KPI"]
    assert not _find(k, maincode="K1")                       # replaced series dropped
    assert len(_find(k, maincode="K2")) == 1                 # NULL KPI kept (N2)
    sick = _find(k, maincode=C.SICKNESS_CODE)
    assert len(sick) == 5 and {r.yearmonth for r in sick} == {202404}   # 202408 cut off
    assert len(_find(k, maincode=C.TURNOVER_CODE)) == 5


def test_hcsw_split(out):
    rates, rest = out["HCSW_Vacancy_Rate"], out["HCSW"]
    assert [r.yearmonth for r in rates.collect()] == [202404]          # cut off
    assert [r.maincode for r in rest.collect()] == ["H2"]             # NULL measure kept, not cut


def test_variance(out):
    v = out["Sickness_Turnover"]
    pct = _find(v, provider="ROH", yearmonth=202404, reference_sheet=C.SICKNESS_SHEET, metric="% Difference")[0]
    assert math.isnan(pct.value)                                   # 0/0 stays NaN here
    plan = _find(v, provider="BWCH", yearmonth=202404, reference_sheet=C.SICKNESS_SHEET, metric="Plan")[0]
    assert plan.value is None                                      # actual without plan kept
    assert v.count() == 10 * 4                                     # 2 sheets x 5 providers x 4 metrics


def test_main_overview(out):
    o = out["Main_Overview"]
    assert not _find(o, system="OTHER")
    assert not _find(o, period=202408)
    bank = _find(o, metric="Bank Usage", staff_group="Clinical Support", system="UHB", period=202404)
    assert [r.value for r in bank] == [3.0, 3.0]                   # duplicated code-list row
    bank_all = _find(o, metric="Bank Usage", staff_group=C.ALL_STAFF_GROUP, system="UHB", period=202404)
    assert [r.value for r in bank_all] == [6.0]                    # summed for All Staff
    ics = _find(o, metric="Substantive Staff In Post", staff_group=C.ALL_STAFF_GROUP, system="ICS", period=202404)
    assert [r.value for r in ics] == [100.0]                       # UHB 100 + ROH 0
    ics_empty = _find(o, metric="Agency Usage", staff_group="Ambulance Service Staff", system="ICS", period=202405)
    assert [r.value for r in ics_empty] == [0.0]                   # all NULL -> 0 (N5)
    ics_rate = _find(o, metric="Vacancy Rate", staff_group=C.ALL_STAFF_GROUP, system="ICS", period=202404)
    assert [r.value for r in ics_rate] == [None]
    med = _find(o, metric="Substantive Staff In Post", staff_group="Medical and dental", system="UHB", period=202404)
    assert [r.value for r in med] == [9.0]                         # NULL-coded row reached its group
    assert [r.date for r in ics] == [dt.date(2024, 4, 1)]
    # 36 pairs x 6 systems x 4 months, plus one extra row for the doubled bank code
    assert o.count() == 36 * 6 * 4 + 1


def test_rejected_providers_are_reported(spark):
    from staffline.plans import lookup, overview
    i = _inputs(spark)
    looked = lookup.lookup_all_sheets(lookup.fact_union_historic(i.historic, i.current), i.ref_long)
    t = lookup.published_lookup_tables(looked)
    facts = overview.metric_facts(t["Overall"], t["Staff_Group"], t["Bank_Agency"], t["Vacancy"],
                                  spark.createDataFrame([], "provider string, yearmonth int, rate double, type string"),
                                  spark.createDataFrame([], "provider string, yearmonth int, reference_sheet string, "
                                                            "metric string, value double"))
    got = sorted(tuple(r) for r in overview.rejected_providers(facts, CFG).collect())
    assert got == [("OTHER", "Substantive Staff In Post", 1)]
