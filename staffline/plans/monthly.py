"""The whole monthly run: fact -> lookup -> measures -> overview -> publish.

The looked-up fact feeds more than ten consumers. It is written once as a table
partitioned by code-list sheet under the shared output folder, which cuts the
lineage (a lost executor re-reads files instead of recomputing the join) and
turns every per-sheet consumer into a partition-pruned scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..config import RunConfig
from ..operators.aggregates import observe_rows
from ..sources.release import Release
from ..sources.sinks import replace_table
from . import lookup, measures, overview, report
from .concurrent import PARALLEL_TABLES, run_along


@dataclass
class RunInputs:
    current: DataFrame          # current-year fact (with load_date)
    historic: DataFrame         # earlier years (maincode, yearmonth, value, provider)
    ref_long: DataFrame         # code list, all sheets, with ``sheet``
    planned_staff: DataFrame    # yearmonth int, provider, type, plan
    planned_rates: DataFrame    # date, yearmonth int, provider, type, plan
    sickness_wide: DataFrame    # date + one column per provider
    turnover_wide: DataFrame


def compute(spark: SparkSession, inputs: RunInputs, cfg: RunConfig = RunConfig(),
            looked_up_path: str | None = None) -> dict[str, DataFrame]:
    """All published outputs by name (lazy, except the optional looked-up table write)."""
    fact = lookup.fact_union_historic(inputs.historic, inputs.current)
    looked = lookup.lookup_all_sheets(fact, inputs.ref_long)
    if looked_up_path:
        looked = lookup.materialize_by_sheet(spark, looked, looked_up_path)

    tables = lookup.published_lookup_tables(looked)
    overall, staff_group = tables["Overall"], tables["Staff_Group"]
    vacancy, bank_agency = tables["Vacancy"], tables["Bank_Agency"]

    vacancies = measures.vacancies_combined(overall, staff_group, vacancy, cfg)
    staffing = measures.staffing_plan_all(overall, staff_group, vacancy, inputs.planned_staff, cfg)
    hcsw_rates, hcsw_rest = measures.hcsw_split(tables["HCSW"], cfg)
    kpi = measures.kpi_override(tables["KPI"], inputs.sickness_wide, inputs.turnover_wide, cfg)
    st_long = measures.sickness_turnover_long(inputs.sickness_wide, inputs.turnover_wide)
    variance = measures.variance_long(st_long, inputs.planned_rates, cfg)
    facts = overview.metric_facts(overall, staff_group, bank_agency, vacancy, vacancies, variance)
    main = overview.main_overview(spark, facts, cfg)

    out = dict(tables)
    out.update({
        "KPI": kpi,
        "HCSW": hcsw_rest,
        "Vacancy_Rate_Calc": vacancies,
        "Staffing_Actual_Plan": staffing,
        "HCSW_Vacancy_Rate": hcsw_rates,
        "Sickness_Turnover": variance,
        "Main_Overview": main,
    })
    return out


def publish(outputs: dict[str, DataFrame], location: str | None = None) -> None:
    """Replace every published table (18 names): with a location as one release, else as catalog tables one by one."""
    names = (*C.PUBLISHED_LOOKUP_TABLES, *C.PUBLISHED_MEASURE_TABLES)
    if not location:
        for name in names:
            replace_table(outputs[name], name)
        return
    release = Release(outputs[names[0]].sparkSession, location)
    for name in names:
        release.write(name, outputs[name])
    release.commit()


def run(spark: SparkSession, inputs: RunInputs, location: str, cfg: RunConfig = RunConfig(),
        parallel: int = PARALLEL_TABLES) -> dict[str, DataFrame]:
    """Compute all 18 tables and publish them as one release under ``location`` (shared storage).

    Independent tables are written by parallel jobs along their dependencies.
    Every consumer reads what its producer wrote, so each stage's lineage starts
    at files: a lost executor re-reads a table instead of recomputing the run,
    and shared inputs are computed once. Readers see the release before this one
    until all tables are written; then one commit switches them all. Row counts
    come from observations on the writes and stand in the manifest.
    """
    release = Release(spark, location)

    def published(name: str, df: DataFrame) -> DataFrame:
        counted, rows = observe_rows(df, f"rows-{name}-{release.name}")
        return release.write(name, counted, rows)

    fact = lookup.fact_union_historic(inputs.historic, inputs.current)
    looked = lookup.lookup_all_sheets(fact, inputs.ref_long)
    looked = lookup.materialize_by_sheet(spark, looked, f"{location.rstrip('/')}/_looked_up/{release.name}")

    tables = lookup.published_lookup_tables(looked)
    tables["HCSW_Vacancy_Rate"], tables["HCSW"] = measures.hcsw_split(tables["HCSW"], cfg)
    tables["KPI"] = measures.kpi_override(tables["KPI"], inputs.sickness_wide, inputs.turnover_wide, cfg)
    st_long = measures.sickness_turnover_long(inputs.sickness_wide, inputs.turnover_wide)
    tables["Sickness_Turnover"] = measures.variance_long(st_long, inputs.planned_rates, cfg)

    def facts(out: dict[str, DataFrame]) -> DataFrame:
        return overview.metric_facts(out["Overall"], out["Staff_Group"], out["Bank_Agency"], out["Vacancy"],
                                     out["Vacancy_Rate_Calc"], out["Sickness_Turnover"])

    def step(name: str, needs: tuple[str, ...], make):
        return name, (needs, lambda out: published(name, make(out)))

    parts = ("Overall", "Staff_Group", "Vacancy")
    steps = dict([
        *(step(name, (), lambda _out, df=df: df) for name, df in tables.items()),
        step("Vacancy_Rate_Calc", parts, lambda out: measures.vacancies_combined(*(out[x] for x in parts), cfg)),
        step("Staffing_Actual_Plan", parts,
             lambda out: measures.staffing_plan_all(*(out[x] for x in parts), inputs.planned_staff, cfg)),
        step("Main_Overview", (*parts, "Bank_Agency", "Vacancy_Rate_Calc", "Sickness_Turnover"),
             lambda out: overview.main_overview(spark, facts(out), cfg)),
    ])
    out = run_along(spark, steps, parallel)
    # the report reads what was published; it stands in the release, not among the 18 tables
    release.write(report.NAME, report.run_report(spark, looked, out, release.counts(), facts(out), cfg))
    release.commit()
    return out
