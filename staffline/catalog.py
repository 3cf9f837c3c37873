"""Registered queries: one per operator of the inventory, each over the
stand-in model derived from the test tables (see ``sources.standins``).

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Queries of
sources/sinks land their input under the shared checkpoint folder first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .functions import periods, semantics
from .operators import aggregates, filters, grid, joins, projections, reshape, unions
from .plans import lookup, measures, monthly, overview
from .session import HASHED_SIDE, landed, scratch_path, settings
from .sources import files, jdbc, sinks, standins
from .sources.release import open_release
from .sources.standins import STANDIN_CONFIG as CFG
from .streaming import inbox, resubmission

HISTORIC_BEFORE = 199704  # first period of the current fiscal year in the stand-in


class Model:
    """Lazily derived stand-in model frames for one data folder.

    ``sheets`` and ``plan_types``: all that a query takes of the looked-up fact
    and of the plans, where it takes them several times and they are written once.
    """

    def __init__(self, spark: SparkSession, d: str, materialize: bool = False, land_plans: bool = False,
                 sheets: tuple[int, ...] = (), plan_types: tuple[str, ...] = ()):
        self.spark, self.d, self.materialize, self.land_plans = spark, d, materialize, land_plans
        self.sheets, self.plan_types = sheets, plan_types

    @cached_property
    def fact(self) -> DataFrame:
        return standins.fact(self.spark, self.d)

    @cached_property
    def ref_long(self) -> DataFrame:
        # landed, as the workbook is: Spark then knows its size before it plans the join with the fact
        return landed(standins.ref_long(self.spark, self.d), "code-list")

    @cached_property
    def looked(self) -> DataFrame:
        looked = lookup.lookup_all_sheets(self.fact, self.ref_long)
        if self.sheets:
            looked = looked.filter(F.col("sheet").isin(*self.sheets))
        if not self.materialize:
            return looked
        # Many consumers: write once, partitioned by sheet, under the shared
        # checkpoint folder; consumers become partition-pruned scans and a lost
        # executor re-reads files instead of recomputing the fact.
        return lookup.materialize_by_sheet(self.spark, looked, scratch_path(self.spark, "looked-up"))

    def t(self, sheet: int) -> DataFrame:
        return lookup.sheet_table(self.looked, sheet)

    @cached_property
    def bank_agency(self) -> DataFrame:
        return lookup.bank_agency(self.looked)

    @cached_property
    def planned_staff(self) -> DataFrame:
        raw = standins.planned_staff_raw(self.spark, self.d)
        planned = raw.withColumn("yearmonth", periods.period_cast("yearmonth"))
        if self.plan_types:
            planned = planned.filter(F.col("type").isin(*self.plan_types))
        if not self.land_plans:
            return planned
        # read by several plan selections: land it once, as the plan workbook is
        with settings(self.spark, adaptive_maxShuffledHashJoinLocalMapThreshold=HASHED_SIDE):
            return landed(planned, "planned-staff")

    @cached_property
    def planned_rates(self) -> DataFrame:
        raw = standins.planned_rates_raw(self.spark, self.d)
        return raw.withColumn("yearmonth", periods.period_cast("yearmonth"))

    @cached_property
    def sickness_wide(self) -> DataFrame:
        return standins.supplied_rates_wide(self.spark, self.d, "sickness")

    @cached_property
    def turnover_wide(self) -> DataFrame:
        return standins.supplied_rates_wide(self.spark, self.d, "turnover")

    @cached_property
    def wide(self) -> DataFrame:
        return standins.wide_submissions(self.spark, self.d)

    @cached_property
    def st_long(self) -> DataFrame:
        return measures.sickness_turnover_long(self.sickness_wide, self.turnover_wide)

    @cached_property
    def variance(self) -> DataFrame:
        return measures.variance_long(self.st_long, self.planned_rates, CFG)

    @cached_property
    def vacancies(self) -> DataFrame:
        return measures.vacancies_combined(self.t(1), self.t(2), self.t(6), CFG)

    @cached_property
    def metric_facts(self) -> DataFrame:
        return overview.metric_facts(self.t(1), self.t(2), self.bank_agency, self.t(6), self.vacancies,
                                     self.variance)

    def land_wide(self) -> str:
        """Land the wide submissions one folder per workbook and sheet."""
        path = scratch_path(self.spark, "inbox")
        self.wide.write.mode("overwrite").partitionBy("submission", "sheet_no").parquet(path)
        return path


def _run_inputs(m: Model) -> monthly.RunInputs:
    f = m.fact
    return monthly.RunInputs(
        current=projections.stamp_load_date(f.filter(F.col("yearmonth") >= HISTORIC_BEFORE), CFG.load_date),
        historic=f.filter(F.col("yearmonth") < HISTORIC_BEFORE),
        ref_long=m.ref_long, planned_staff=m.planned_staff, planned_rates=m.planned_rates,
        sickness_wide=m.sickness_wide, turnover_wide=m.turnover_wide)


WIDE_FILE_COLUMNS = ("Organisation", "Fiscal Year", "Sheet", "Staff Group", "Description",
                     *standins.WIDE_MONTH_HEADERS, "Year To Date", "Maincode")


def _ingest(df: DataFrame) -> DataFrame:
    return inbox.submissions_long(df, CFG.latest_month, CFG.fiscal_year_marker, marker_is_regex=True,
                                  load_date=CFG.load_date)


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

def src_dir_scan(spark, d):
    m = Model(spark, d)
    return inbox.read_inbox(spark, m.land_wide(), WIDE_FILE_COLUMNS)


def src_provider_from_filename(spark, d):
    m = Model(spark, d)
    df = files.scan_dir(spark, m.land_wide(), schema=inbox.wide_schema(WIDE_FILE_COLUMNS))
    named = files.with_file_columns(df, CFG.fiscal_year_marker, marker_is_regex=True,
                                   folder_key="submission")
    return named.select("file_name", "provider").distinct()


def src_sheet_range(spark, d):
    m = Model(spark, d)
    df = inbox.read_inbox(spark, m.land_wide(), WIDE_FILE_COLUMNS)
    return files.sheets_between(df, *C.SUBMISSION_SHEETS)


def src_named_sheet(spark, d):
    m = Model(spark, d)
    path = scratch_path(spark, "code-list")
    m.ref_long.write.mode("overwrite").partitionBy("sheet").parquet(path)
    book = spark.read.parquet(path)
    return files.named_sheet(book, C.SHEET_VACANCY).select("maincode", "reference_sheet", "staff_group", "staff_type")


def src_csv_roundtrip(spark, d):
    m = Model(spark, d)
    path = scratch_path(spark, "combined-csv")
    files.write_csv(projections.stamp_load_date(m.fact, CFG.load_date), path)
    return files.read_csv(spark, path)


def src_historic_query(spark, d):
    m = Model(spark, d)
    path = scratch_path(spark, "historic")
    hist = m.fact.filter(F.col("yearmonth") < HISTORIC_BEFORE).withColumns(
        {"load_date": F.lit(CFG.load_date).cast("date"), "note": F.lit("archived")})
    hist.write.mode("overwrite").parquet(path)
    return jdbc.read_historic_table(spark, path)


def stream_inbox_ingest(spark, d):
    m = Model(spark, d)
    src = m.land_wide()
    out, ckpt, arch = (scratch_path(spark, n) for n in ("fact", "ingest-ckpt", "archive"))
    inbox.stream_inbox(spark, src, out, ckpt, WIDE_FILE_COLUMNS, CFG.latest_month, archive=arch,
                       marker=CFG.fiscal_year_marker, marker_is_regex=True, load_date=CFG.load_date)
    return inbox.read_fact(spark, out)


def inbox_resubmitted(spark, d):
    """Three runs that follow the content of the inbox: all workbooks; one provider's workbooks resent under
    their old names with another first month; the same inbox again, which changes nothing."""
    m = Model(spark, d)
    src, out = m.land_wide(), scratch_path(spark, "fact-by-content")
    settings = dict(marker=CFG.fiscal_year_marker, marker_is_regex=True, load_date=CFG.load_date)

    def ingest():
        wide = inbox.read_inbox(spark, src, WIDE_FILE_COLUMNS)
        return resubmission.ingest_by_content(spark, wide, out, CFG.latest_month, **settings)

    ingest()
    resent = m.wide.where(F.col("submission").startswith("ASIA ")).withColumn(WIDE_FILE_COLUMNS[5], F.lit("7"))
    (resent.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("submission", "sheet_no").parquet(src))
    ingest()
    if ingest():
        raise RuntimeError("an unchanged inbox was ingested again")
    return resubmission.read_fact_by_content(spark, out)


def inbox_csv_banner(spark, d):
    """The wide submissions landed as CSV sheets with a banner line and a header line, ingested in one splittable scan."""
    m = Model(spark, d)
    src = scratch_path(spark, "inbox-csv")
    cells = [F.coalesce(F.concat(F.lit('"'), F.regexp_replace(F.col(f"`{c}`"), '"', '""'), F.lit('"')), F.lit(""))
             for c in WIDE_FILE_COLUMNS]
    lines = m.wide.select(F.lit(2).alias("part"), F.concat_ws(",", *cells).alias("value"), "submission", "sheet_no")
    head = F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit("Monthly return").alias("value")),
                             F.struct(F.lit(1).alias("part"), F.lit(",".join(WIDE_FILE_COLUMNS)).alias("value"))))
    heads = m.wide.select("submission", "sheet_no").distinct().select(head.alias("h"), "submission", "sheet_no").select(
        "h.part", "h.value", "submission", "sheet_no")
    # one file per workbook and sheet, as sheets are exported: the two head lines, then the rows
    keys = ["submission", "sheet_no"]
    (lines.unionByName(heads).repartition(*keys).sortWithinPartitions(*keys, "part").drop("part")
     .write.partitionBy(*keys).text(src))
    columns = inbox.landed_columns(spark, src, "csv")
    return _ingest(inbox.read_inbox(spark, src, columns, "csv"))


def monthly_tables_profile(spark, d):
    """All 18 published tables of one release: rows, and the sum of the leading measure."""
    location = scratch_path(spark, "published")
    monthly.run(spark, _run_inputs(Model(spark, d, land_plans=True)), location, CFG)
    published = open_release(spark, location)
    parts = []
    for name in (*C.PUBLISHED_LOOKUP_TABLES, *C.PUBLISHED_MEASURE_TABLES):
        value = F.col({"Vacancy_Rate_Calc": "total", "Staffing_Actual_Plan": "plan"}.get(name, "value"))
        finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
        parts.append(published.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                               F.round(F.sum(finite), 4).alias("total")))
    return reduce(DataFrame.unionByName, parts)


def sink_replace_table(spark, d):
    m = Model(spark, d)
    loc = scratch_path(spark, "published")
    overall = m.t(C.SHEET_OVERALL)
    # last month's publication (earlier periods only) is replaced by this month's
    sinks.replace_table(overall.filter(F.col("yearmonth") < HISTORIC_BEFORE), "Overall", loc)
    sinks.replace_table(overall, "Overall", loc)
    return sinks.read_published(spark, "Overall", loc)


def proj_load_date(spark, d):
    return projections.stamp_load_date(Model(spark, d).fact, CFG.load_date)


# ---------------------------------------------------------------------------
# Projections, filters, reshapes
# ---------------------------------------------------------------------------

def proj_positional(spark, d):
    w = Model(spark, d).wide
    return projections.select_positions(w, [*C.WIDE_MONTH_POSITIONS, C.WIDE_CODE_POSITION])


def proj_named(spark, d):
    return projections.select_named(Model(spark, d).t(1), "provider", "yearmonth", "value", "summary_detail")


def proj_drop(spark, d):
    cur = projections.stamp_load_date(Model(spark, d).fact, CFG.load_date)
    return projections.drop_columns(cur, "load_date")


def proj_rename(spark, d):
    return projections.rename(Model(spark, d).t(6), {"value": "vacancy", "yearmonth": "period"})


def proj_constant(spark, d):
    return projections.add_constants(Model(spark, d).t(6), {"type": "Vacancy", "source": "submission"})


def filter_valid_codes(spark, d):
    w = Model(spark, d).wide
    return filters.valid_codes(w, "Maincode").select("submission", "sheet_no", "Maincode")


def filter_conjunction(spark, d):
    return filters.equals_all(Model(spark, d).t(2), {"staff_group": C.NURSING_GROUP, "staff_type": C.TOTAL_TYPE})


def filter_in(spark, d):
    return filters.is_in(Model(spark, d).t(12), "measure_detail", C.HCSW_RATE_MEASURES)


def filter_not_in_keep_null(spark, d):
    return filters.not_in_keep_null(Model(spark, d).t(5), "workforce_kpi", [C.TURNOVER_KPI, C.SICKNESS_KPI])


def filter_not_equal(spark, d):
    return filters.not_equal(Model(spark, d).bank_agency, "staff_group", C.ALL_STAFF_GROUP)


def filter_cutoff(spark, d):
    return filters.cutoff(Model(spark, d).fact, CFG.latest_month)


def filter_split(spark, d):
    rates, rest = measures.hcsw_split(Model(spark, d).t(12), CFG)
    return rates.withColumn("part", F.lit("rate")).unionByName(rest.withColumn("part", F.lit("rest")))


def reshape_months_long(spark, d):
    w = Model(spark, d).wide
    months = projections.positional_names(w, C.WIDE_MONTH_POSITIONS)
    long = reshape.months_long(w, ["submission", "sheet_no", "Maincode"], months, labels=list(range(1, 13)),
                               names_to="fiscal_month")
    return long


def reshape_providers_long(spark, d):
    w = Model(spark, d).sickness_wide
    return reshape.providers_long(w, ["date"], list(standins.REGIONS))


def reshape_measures_long(spark, d):
    m = Model(spark, d)
    actual = m.st_long.select("provider", "yearmonth", "reference_sheet", F.col("value").alias("Actual"))
    j = joins.left_null_safe(actual, m.planned_rates.drop("date"),
                             ["provider", "yearmonth", ("reference_sheet", "type")])
    j = j.withColumnRenamed("plan", "Plan").withColumns({
        "Variance": F.col("Actual") - F.col("Plan"),
        "% Difference": semantics.ieee_div(F.col("Actual") - F.col("Plan"), F.col("Plan"))})
    return reshape.measures_long(j, ["provider", "yearmonth", "reference_sheet"], measures.MEASURE_LABELS)


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

def join_code_lookup(spark, d):
    m = Model(spark, d)
    ref = m.ref_long
    return joins.inner_null_safe(m.fact, ref, ["maincode"])


def join_inner_two_keys(spark, d):
    m = Model(spark, d)
    vac, sub = measures.main_vacancy_parts(m.t(1), m.t(6))
    return joins.inner_null_safe(vac, sub, ["provider", "yearmonth"])


def join_fan_out(spark, d):
    """Exact rows per key of the vacancy join, before it is run."""
    m = Model(spark, d)
    vac, sub = measures.main_vacancy_parts(m.t(1), m.t(6))
    return joins.fan_out(vac, sub, ["provider", "yearmonth"])


def join_full_outer(spark, d):
    m = Model(spark, d)
    actual = measures.wte_by_type(m.t(1), C.AGENCY_WTE, cfg=CFG)
    plan = measures.plan_selector(m.planned_staff, C.AGENCY_PLAN, cfg=CFG)
    return joins.full_outer_coalesced(actual, plan, ["provider", "yearmonth"])


def join_left_renamed_key(spark, d):
    m = Model(spark, d)
    actual = m.st_long.select("provider", "yearmonth", "reference_sheet", F.col("value").alias("actual"))
    return joins.left_null_safe(actual, m.planned_rates.drop("date"),
                                ["provider", "yearmonth", ("reference_sheet", "type")])


def _overview_subset(spark, d, pairs):
    m = Model(spark, d, materialize=True)
    g = grid.dense_grid(grid.systems_frame(spark, CFG.systems), pairs, CFG.grid_first_period,
                        min(CFG.grid_last_period, CFG.latest_month))
    return overview.grid_left_join(g, m.metric_facts, CFG)


def overview_all_staff(spark, d):
    return _overview_subset(spark, d, [p for p in overview.kept_pairs(CFG) if p[1] == C.ALL_STAFF_GROUP])


def overview_staff_groups(spark, d):
    return _overview_subset(spark, d, [p for p in overview.kept_pairs(CFG) if p[1] != C.ALL_STAFF_GROUP])


def overview_ics_rollup(spark, d):
    return main_overview(spark, d).filter(F.col("system") == CFG.grid_total_system)


def grid_cross_product(spark, d):
    regions = standins.table(spark, d, "region").select(F.col("r_name").alias("system"))
    systems = regions.unionByName(spark.createDataFrame([(CFG.grid_total_system,)], "system string"))
    return grid.dense_grid(systems, grid.all_pairs(CFG.metrics, CFG.staff_groups), CFG.grid_first_period,
                           CFG.grid_last_period)


def join_collision_names(spark, d):
    m = Model(spark, d)
    g = grid.dense_grid(grid.systems_frame(spark, CFG.systems), [("Vacancies", C.ALL_STAFF_GROUP)],
                        CFG.grid_first_period, CFG.grid_last_period)
    src = m.t(6).select("yearmonth", "provider", "value", "staff_group", "staff_type").filter(
        (F.col("staff_group") == C.ALL_ROLES) & (F.col("staff_type") == C.TOTAL_TYPE))
    j = joins.join_with_suffixes(g, src, [("system", "provider"), ("period", "yearmonth")], "left")
    return j.drop("staff_group.y", "staff_type").withColumnRenamed("staff_group.x", "staff_group")


# ---------------------------------------------------------------------------
# Aggregations, unions
# ---------------------------------------------------------------------------

def _planted_null_plans(m: Model) -> DataFrame:
    """Planned staff with two blank cells: one month of one series, and every
    month of another series."""
    p = m.planned_staff
    one = (F.col("provider") == "AMERICA") & (F.col("yearmonth") == 199712) & (F.col("type") == C.BANK_PLAN)
    every = (F.col("provider") == "ASIA") & (F.col("type") == "Other Plan")
    return p.withColumn("plan", F.when(one | every, F.lit(None).cast("double")).otherwise(F.col("plan")))


def agg_strict_sum(spark, d):
    return aggregates.group_strict_sum(_planted_null_plans(Model(spark, d)), ["provider", "type"], "plan")


def agg_sum_na_rm(spark, d):
    return aggregates.group_sum_na_rm(_planted_null_plans(Model(spark, d)), ["provider", "type"], "plan")


def agg_system_total(spark, d):
    m = Model(spark, d)
    sub = measures.wte_by_type(m.t(1), C.SUBSTANTIVE_WTE, cfg=CFG)
    return aggregates.with_system_total(sub, ["substantive"], CFG.system_total_label)


def agg_distinct_profile(spark, d):
    return aggregates.distinct_profile(Model(spark, d).looked, ["sheet", "reference_sheet"])


def agg_row_count(spark, d):
    """Row counts from the Observations of one action on the contracted union."""
    m = Model(spark, d)
    result, main_rows, result_rows = unions.union_contracted_counted(m.t(1), m.t(6), CFG.load_date)
    result.write.format("noop").mode("overwrite").save()
    counts = spark.range(2).select(
        F.when(F.col("id") == 0, F.lit(main_rows.get["rows"])).otherwise(F.lit(result_rows.get["rows"])).cast("long").alias("rows"),
        F.when(F.col("id") == 0, F.lit("main")).otherwise(F.lit("result")).alias("frame"))
    return counts


def union_strict(spark, d):
    m = Model(spark, d)
    kept = filters.not_in_keep_null(m.t(5), "workforce_kpi", [C.TURNOVER_KPI, C.SICKNESS_KPI])
    return unions.union_strict(kept, m.st_long)


def union_fill_missing(spark, d):
    m = Model(spark, d, materialize=True, land_plans=True, sheets=(C.SHEET_OVERALL, C.SHEET_VACANCY),
              plan_types=(C.SUBSTANTIVE_PLAN, C.AGENCY_PLAN))
    main = measures.plan_vs_actual(measures.vacancy_rate(m.t(1), m.t(6)),
                                   measures.plan_selector(m.planned_staff, C.SUBSTANTIVE_PLAN, cfg=CFG))
    agency = measures.actual_vs_plan(measures.wte_by_type(m.t(1), C.AGENCY_WTE, cfg=CFG),
                                     measures.plan_selector(m.planned_staff, C.AGENCY_PLAN, cfg=CFG))
    return unions.union_fill_missing(main, agency)


def union_contracted(spark, d):
    m = Model(spark, d)
    return unions.union_contracted(m.t(1), m.t(6), CFG.load_date)


# ---------------------------------------------------------------------------
# Scalars
# ---------------------------------------------------------------------------

def scalar_numeric_coerce(spark, d):
    mv = standins.messy_values(spark, d)
    return mv.withColumn("value", semantics.to_number("raw"))


def scalar_abs(spark, d):
    m = Model(spark, d)
    raw = m.looked.filter(F.col("sheet") == C.SHEET_VACANCY)
    return raw.select("maincode", "yearmonth", "provider", F.abs("value").alias("value"))


def _line_ratios(spark, d) -> DataFrame:
    li = standins.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_tax") + F.col("l_discount")).alias("total"),
                     (F.col("l_tax") - F.col("l_discount")).alias("difference"),
                     semantics.ieee_div("l_tax", "l_discount").alias("ratio"))


def scalar_ratio_ieee(spark, d):
    return _line_ratios(spark, d)


def scalar_nan_to_null(spark, d):
    return semantics.nan_to_null_all(_line_ratios(spark, d))


def scalar_case_when(spark, d):
    m = Model(spark, d)
    kpi = unions.union_strict(m.t(5), m.st_long)
    return kpi.select("maincode", "yearmonth", "provider", "workforce_kpi",
                      measures.kpi_type("workforce_kpi").alias("type"))


def scalar_date_to_period(spark, d):
    o = standins.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", periods.date_to_period("o_orderdate").alias("period"))


def scalar_period_to_date(spark, d):
    f = Model(spark, d).fact.select("yearmonth").distinct()
    return f.select("yearmonth", periods.period_to_date("yearmonth").alias("date"))


def scalar_month_sequence(spark, d):
    o = standins.table(spark, d, "orders").select("o_custkey", "o_orderdate")
    cp = standins.customer_provider(spark, d)
    span = o.join(cp, o.o_custkey == cp.c_custkey).groupBy("provider").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return span.select("provider", F.explode(periods.month_sequence("first", "last")).alias("month"))


def scalar_period_cast(spark, d):
    raw = standins.planned_staff_raw(spark, d)
    return raw.withColumn("yearmonth", periods.period_cast("yearmonth"))


# ---------------------------------------------------------------------------
# Composite operators
# ---------------------------------------------------------------------------

def ingest_wide_submissions(spark, d):
    return _ingest(Model(spark, d).wide)


def fact_union_historic(spark, d):
    f = Model(spark, d).fact
    historic = f.filter(F.col("yearmonth") < HISTORIC_BEFORE)
    current = projections.stamp_load_date(f.filter(F.col("yearmonth") >= HISTORIC_BEFORE), CFG.load_date)
    return lookup.fact_union_historic(historic, current)


def lookup_all_sheets(spark, d):
    return Model(spark, d).looked


def lookup_bank_agency(spark, d):
    return Model(spark, d).bank_agency


def measure_vacancy_rate(spark, d):
    m = Model(spark, d)
    return measures.vacancy_rate(m.t(1), m.t(6))


def measure_vacancy_rate_group(spark, d):
    m = Model(spark, d)
    return measures.vacancy_rate_group(m.t(2), m.t(6))


def measure_vacancy_rate_system(spark, d):
    m = Model(spark, d)
    return unions.union_fill_missing(measures.vacancy_rate_system(m.t(1), m.t(6), CFG),
                                     measures.vacancy_rate_group_system(m.t(2), m.t(6), CFG))


def measure_vacancies_combined(spark, d):
    return Model(spark, d, materialize=True).vacancies


def plan_by_type(spark, d):
    return measures.plan_selector(Model(spark, d).planned_staff, C.SUBSTANTIVE_PLAN, cfg=CFG)


def plan_system_total(spark, d):
    p = measures.plan_selector(Model(spark, d).planned_staff, C.SUBSTANTIVE_PLAN, cfg=CFG)
    return measures.plan_selector(p, system=True, cfg=CFG)


def measure_plan_vs_actual(spark, d):
    m = Model(spark, d)
    return measures.plan_vs_actual(measures.vacancy_rate(m.t(1), m.t(6)),
                                   measures.plan_selector(m.planned_staff, C.SUBSTANTIVE_PLAN, cfg=CFG))


def wte_by_type(spark, d):
    m = Model(spark, d)
    return unions.union_fill_missing(measures.wte_by_type(m.t(1), C.AGENCY_WTE, cfg=CFG),
                                     measures.wte_by_type(m.t(1), C.AGENCY_WTE, system=True, cfg=CFG))


def measure_actual_vs_plan(spark, d):
    m = Model(spark, d)
    return measures.actual_vs_plan(measures.wte_by_type(m.t(1), C.AGENCY_WTE, cfg=CFG),
                                   measures.plan_selector(m.planned_staff, C.AGENCY_PLAN, cfg=CFG))


def measure_staffing_plan_all(spark, d):
    m = Model(spark, d, materialize=True, land_plans=True)
    return measures.staffing_plan_all(m.t(1), m.t(2), m.t(6), m.planned_staff, CFG)


def kpi_override(spark, d):
    m = Model(spark, d)
    return measures.kpi_override(m.t(5), m.sickness_wide, m.turnover_wide, CFG)


def measure_variance_long(spark, d):
    return Model(spark, d).variance


def main_overview(spark, d):
    return overview.main_overview(spark, Model(spark, d, materialize=True).metric_facts, CFG)


def monthly_run_published(spark, d):
    """The whole run (C18): historic + current fact, lookup written once by
    sheet, every measure and the overview published as one release under the
    shared folder; returns the published overview."""
    location = scratch_path(spark, "published")
    monthly.run(spark, _run_inputs(Model(spark, d, land_plans=True)), location, CFG)
    return open_release(spark, location).table("Main_Overview")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and getattr(fn, "__module__", None) == __name__ and not name.startswith("_")
    and name not in {"Model", "QUERIES"} and fn.__code__.co_varnames[:2] == ("spark", "d")
}
