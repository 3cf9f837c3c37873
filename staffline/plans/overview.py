"""Dense dashboard dataset: metric x staff group x system x month.

Design (equivalent to twelve slice joins plus a roll-up re-join):

* ``metric_facts`` stacks the twelve metric sources as ``(metric, staff_group,
  system, period, value)``. Slices 1-8 carry the literal ``All Staff`` group;
  slices 9-12 carry their own group and drop ``All Staff`` rows so they cannot
  land in an all-staff cell. The slices partition the grid, so one left join of
  the grid with the stack equals the union of the twelve slice joins, fan-out
  included.
* the facts are inner-joined with the broadcast grid, so they are not shuffled
  and a hot cell needs no split. The matched rows are evaluated once and landed.
* one aggregate over them and the tagged grid cells gives, per cell, how many
  facts it has and the NA-ignoring total of its systems: each fact counts in its
  own cell and adds its value to the system cell above it. There are at most as
  many groups as grid cells, with a map-side partial.
* the result is the matched rows, the cells without a fact, and for the system
  (``ICS``) cells the totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import RunConfig
from ..functions.periods import period_to_date
from ..functions.semantics import nan_to_null, not_in
from ..operators.aggregates import group_strict_sum
from ..operators.filters import cutoff
from ..operators.grid import dense_grid, systems_frame
from ..operators.unions import union_fill_missing
from ..session import landed

OUT_COLUMNS = ("metric", "staff_group", "system", "period", "value", "date")
GROUP_METRICS = ("Substantive Staff In Post", "Bank Usage", "Agency Usage", "Vacancies")


def kept_pairs(cfg: RunConfig = RunConfig()) -> list[tuple[str, str]]:
    """The 36 (metric, staff group) pairs that are filled: every metric for All
    Staff, four metrics for each other group."""
    pairs = [(m, C.ALL_STAFF_GROUP) for m in cfg.metrics]
    pairs += [(m, g) for m in GROUP_METRICS for g in cfg.staff_groups if g != C.ALL_STAFF_GROUP]
    return pairs


def _slice(df: DataFrame, metric: str, value: str = "value", group=None) -> DataFrame:
    g = F.lit(C.ALL_STAFF_GROUP) if group is None else F.col(group)
    return df.select(F.lit(metric).alias("metric"), g.alias("staff_group"), F.col("provider").alias("system"),
                     F.col("yearmonth").alias("period"), F.col(value).cast("double").alias("value"))


def _labelled(df: DataFrame, label_col: str, labels: dict[str, str]) -> DataFrame:
    """Rows whose ``label_col`` is one of ``labels``, with ``metric`` set from it.
    Lets two slices that read the same source share one scan."""
    metric = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])[F.col(label_col)]
    return df.filter(F.col(label_col).isin(list(labels))).withColumn("metric", metric)


def _slice_m(df: DataFrame, value: str = "value", group=None) -> DataFrame:
    g = F.lit(C.ALL_STAFF_GROUP) if group is None else F.col(group)
    return df.select("metric", g.alias("staff_group"), F.col("provider").alias("system"),
                     F.col("yearmonth").alias("period"), F.col(value).cast("double").alias("value"))


def metric_facts(overall: DataFrame, staff_group_tbl: DataFrame, bank_agency: DataFrame, vacancy: DataFrame,
                 vacancies: DataFrame, variance: DataFrame) -> DataFrame:
    """The twelve metric sources stacked in grid coordinates.

    Slices that differ only in one label of the same source (substantive/total
    staff, bank/agency, sickness/turnover) are computed in one pass each.
    """
    m = C.METRICS
    total = F.col("staff_type") == C.TOTAL_TYPE
    wte = {C.SUBSTANTIVE_WTE: m[0], C.ALL_STAFF_WTE: m[7]}
    usage = {C.BANK: m[1], C.AGENCY: m[2]}
    rates = {C.SICKNESS_SHEET: m[5], C.TURNOVER_SHEET: m[6]}
    ba = _labelled(bank_agency.filter(total), "bank_agency", usage)

    all_staff = [
        _slice_m(_labelled(overall, "summary_detail", wte)),
        _slice_m(group_strict_sum(ba, ["yearmonth", "provider", "metric"], "value")),
        _slice(vacancy.filter((F.col("staff_group") == C.ALL_ROLES) & total), m[3]),
        _slice(vacancies.filter(F.col("type") == C.MAIN_VACANCY), m[4], value="rate"),
        _slice_m(_labelled(variance.filter(F.col("metric") == "Actual").drop("metric"), "reference_sheet", rates)),
    ]
    substantive = group_strict_sum(
        staff_group_tbl.filter(total & not_in("staff_group", C.EXCLUDED_SUBSTANTIVE_GROUPS)),
        ["provider", "yearmonth", "staff_group"], "value")
    by_group = [
        _slice(substantive, m[0], group="staff_group"),
        _slice_m(ba, group="staff_group"),
        _slice(vacancy.filter(total & not_in("staff_group", C.EXCLUDED_VACANCY_GROUPS)), m[3], group="staff_group"),
    ]
    by_group = [d.filter(F.col("staff_group") != C.ALL_STAFF_GROUP) for d in by_group]
    return union_fill_missing(*all_staff, *by_group)


def rejected_providers(facts: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Data-quality check: providers in the metric sources that are not grid
    systems and so never reach the overview (the system-total label excepted),
    with their row counts per metric."""
    known = list(cfg.systems) + [cfg.system_total_label]
    return (facts.filter(~F.coalesce(F.col("system").isin(known), F.lit(False)))
            .groupBy("system", "metric").agg(F.count(F.lit(1)).alias("rows")))


def overview_grid(spark: SparkSession, cfg: RunConfig = RunConfig(), systems: DataFrame | None = None) -> DataFrame:
    """Grid of kept pairs over all systems and months up to the cut-off."""
    sys_df = systems if systems is not None else systems_frame(spark, cfg.systems)
    last = cfg.last_period
    return dense_grid(sys_df, kept_pairs(cfg), cfg.grid_first_period, last)


CELL = ("metric", "staff_group", "system", "period")
#: a grid larger than this is not broadcast
MAX_GRID_CELLS = 1_000_000


def matched_facts(grid: DataFrame, facts: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """The facts that lie in a grid cell.

    Facts outside the grid's domain cannot match and are dropped by literal
    predicates first. The domain bounds the cells, so the grid is broadcast
    behind a check of that bound; beyond it the join is left to Spark.
    """
    domain = (
        F.col("system").isin(list(cfg.systems))
        & F.col("period").between(cfg.grid_first_period, cfg.last_period)
        & F.col("metric").isin(list(cfg.metrics))
        & F.col("staff_group").isin(list(cfg.staff_groups))
    )
    months = (cfg.last_period // 100 - cfg.grid_first_period // 100) * 12 + cfg.last_period % 100 - cfg.grid_first_period % 100 + 1
    cells = max(months, 0) * len(cfg.metrics) * len(cfg.staff_groups) * len(cfg.systems)
    small = F.broadcast if cells <= MAX_GRID_CELLS else lambda df: df
    # rows of the domain only, so the bound holds whatever grid is passed
    inside = grid.filter(domain)
    return facts.filter(domain).join(small(inside.distinct()), list(CELL), "inner").select(*CELL, "value")


def cell_totals(grid: DataFrame, matched: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """(cell, facts, total, cells): facts of each grid cell, for a system cell the NA-ignoring sum over the
    other systems, and how often the grid holds the cell. One aggregate, one group per cell."""
    system = F.lit(cfg.grid_total_system)
    is_total = F.coalesce(F.col("system") == system, F.lit(False))
    own = F.struct(F.col("system"), F.lit(1).alias("fact"), F.lit(None).cast("double").alias("part"))
    above = F.struct(system.alias("system"), F.lit(0).alias("fact"), nan_to_null("value").alias("part"))
    levels = F.when(is_total, F.array(own)).otherwise(F.array(own, above))
    facts = matched.withColumn("level", F.explode(levels)).select(
        "metric", "staff_group", "level.system", "period", "level.fact", "level.part", F.lit(0).alias("cell"))
    cells = grid.select(*CELL, F.lit(0).alias("fact"), F.lit(None).cast("double").alias("part"), F.lit(1).alias("cell"))
    summed = facts.unionByName(cells).groupBy(*CELL).agg(
        F.sum("fact").alias("facts"), F.sum("part").alias("total"), F.sum("cell").alias("cells"))
    return summed.filter(F.col("cells") > 0)


def _empty_cells(cells: DataFrame, value) -> DataFrame:
    """Every grid cell without a fact, as often as the grid holds it."""
    return (cells.filter(F.col("facts") == 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("cells"))))
            .select(*CELL, value.cast("double").alias("value")))


def grid_left_join(grid: DataFrame, facts: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Every grid cell with its facts, or with NULL where it has none; the facts are evaluated once."""
    matched = landed(matched_facts(grid, facts, cfg), "overview-matched")
    return matched.unionByName(_empty_cells(cell_totals(grid, matched, cfg), F.lit(None)))


def ics_rollup(overview: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """System rows take the NA-ignoring sum of the other systems; rate metrics
    are NULL there (rates do not add up). Adds the first-of-month date.

    The sums are aggregated per grid key with a map-side partial and joined to
    the system rows only, so no task holds the rows of a whole cell.
    """
    keys = ["period", "staff_group", "metric"]
    total_sys = cfg.grid_total_system
    is_total = F.coalesce(F.col("system") == total_sys, F.lit(False))
    sums = overview.filter(~is_total).groupBy(*keys).agg(F.sum(nan_to_null("value")).alias("total"))
    total = F.when(F.col("metric").isin(list(cfg.rate_metrics)), F.lit(None).cast("double")).otherwise(
        F.coalesce(F.col("total"), F.lit(0.0)))
    system_rows = overview.filter(is_total).drop("value").join(sums, keys, "left").withColumn("value", total)
    columns = ["metric", "staff_group", "system", "period", "value"]
    rows = overview.filter(~is_total).select(*columns).unionByName(system_rows.select(*columns))
    return cutoff(rows.withColumn("date", period_to_date("period")), cfg.latest_month, "period")


def main_overview(spark: SparkSession, facts: DataFrame, cfg: RunConfig = RunConfig(),
                  systems: DataFrame | None = None) -> DataFrame:
    """``ics_rollup(grid_left_join(grid, facts))`` from one evaluation of the facts.

    The matched facts and the cell totals (at most one row per grid cell) are
    landed; the result reads the facts twice and the totals twice.
    """
    grid = overview_grid(spark, cfg, systems)
    matched = landed(matched_facts(grid, facts, cfg), "overview-matched")
    cells = landed(cell_totals(grid, matched, cfg), "overview-cells")
    is_total = F.coalesce(F.col("system") == cfg.grid_total_system, F.lit(False))
    total = F.when(F.col("metric").isin(list(cfg.rate_metrics)), F.lit(None).cast("double")).otherwise(
        F.coalesce(F.col("total"), F.lit(0.0)))
    # as many rows as system cells of the grid
    totals = cells.filter(is_total).select(*CELL, total.alias("value"))
    system_rows = matched.filter(is_total).drop("value").join(totals, list(CELL), "inner")
    rows = (matched.filter(~is_total).unionByName(system_rows.select(*CELL, "value"))
            .unionByName(_empty_cells(cells, F.when(is_total, total))))
    return cutoff(rows.withColumn("date", period_to_date("period")), cfg.latest_month, "period").select(*OUT_COLUMNS)
