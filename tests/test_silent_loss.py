"""Rows that used to vanish without a word: markers, grid end, periods, fact reads, fiscal years, numbers."""

import math

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from staffline import cli
from staffline import config as C
from staffline.config import RunConfig, fiscal_year_labels, labels_of_marker
from staffline.functions import periods, semantics
from staffline.functions.text import marker_in_name
from staffline.plans import lookup, overview
from staffline.streaming import inbox

HEADS = ["Org", "Year", "Sheet", "Group", "Desc", *[f"M{i}" for i in range(1, 13)], "YTD", "Maincode"]


def wide(spark, name):
    row = ("x", "y", "s", "g", "d", *[str(i) for i in range(1, 13)], "78", "S1", name, 3)
    return spark.createDataFrame([row], ", ".join(f"`{h}` string" for h in HEADS) + ", submission string, sheet_no int")


@pytest.mark.parametrize("name, marker", [
    ("UHB 31-07 24-25 M04", "24-25"), ("UHB 23-24 M01", "23-24"), ("UHB 99-00", "99-00"), ("NoMarker", None), ("UHB 2024-25", None)])
def test_marker_is_two_consecutive_years(spark, name, marker):
    frame = spark.createDataFrame([(name,)], "n string")
    assert frame.select(marker_in_name("n").alias("m")).first()["m"] == marker


def test_configured_marker_wins(spark):
    frame = spark.createDataFrame([("UHB 22-23 final 24-25",)], "n string")
    assert frame.select(marker_in_name("n", "24-25").alias("m")).first()["m"] == "24-25"


def test_date_in_the_name_is_no_year(spark):
    got = inbox.submissions_long(wide(spark, "UHB 31-07 24-25 M04"), 202407)
    assert sorted(r["yearmonth"] for r in got.collect()) == [202404, 202405, 202406, 202407]


def test_workbook_without_a_year_raises_or_takes_the_labels(spark):
    with pytest.raises(Exception, match="NoMarker"):
        inbox.submissions_long(wide(spark, "NoMarker"), 202407).collect()
    got = inbox.submissions_long(wide(spark, "NoMarker"), 202407, fallback_labels=fiscal_year_labels(2024))
    assert sorted(r["yearmonth"] for r in got.collect()) == [202404, 202405, 202406, 202407]
    assert labels_of_marker("24-25") == fiscal_year_labels(2024) and labels_of_marker("x") == ()


def test_grid_follows_the_latest_month(spark):
    grid = overview.overview_grid(spark, RunConfig(latest_month=202506, grid_first_period=202503))
    assert sorted(r[0] for r in grid.select("period").distinct().collect()) == [202503, 202504, 202505, 202506]


def test_period_text_of_a_decimal_cell(spark):
    frame = spark.createDataFrame([(t,) for t in ("202404.0", " 202404\t", "202404", "n/a", "12d", "NaN", "1e99", None)], "t string")
    assert [r[0] for r in frame.select(periods.period_cast("t")).collect()] == [202404] * 3 + [None] * 5


def test_read_fact_hides_only_a_missing_table(spark, tmp_path):
    assert inbox.read_fact(spark, str(tmp_path / "none")).count() == 0
    path = str(tmp_path / "fact")
    spark.createDataFrame([("S1", 202404, "1", "UHB")], "maincode string, yearmonth int, value string, provider string").write.parquet(path)
    with pytest.raises(AnalysisException):
        inbox.read_fact(spark, path)


def test_a_fiscal_year_in_both_tables_counts_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [("S1", 202403, "1", "UHB"), ("S1", 202404, "2", "UHB")]
    schema = "maincode string, yearmonth int, value string, provider string"
    inbox.write_fact(spark.createDataFrame(rows, schema).withColumn("load_date", F.to_date(F.lit("2024-08-05"))), path)
    current = cli.of_fiscal_year(inbox.read_fact(spark, path), labels_of_marker("24-25"))
    both = lookup.fact_union_historic(spark.createDataFrame(rows[:1], schema), current)
    assert sorted((r["yearmonth"], r["value"]) for r in both.collect()) == [(202403, "1"), (202404, "2")]


def test_empty_inbox_has_no_columns(spark, tmp_path):
    assert cli.inbox_columns(spark, str(tmp_path)) == []
    assert cli.inbox_columns(spark, str(tmp_path / "none")) == []


def test_number_edges(spark):
    texts = ["0xFFFFFFFFFFFFFFFFFFFF", "0x1A", "-0x10", "0x0", "12d\t", "\t12 ", "1e3", "12f"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(semantics.to_number("t")).collect()] == [float(16**20 - 1), 26, -16, 0, 0, 12, 1000, 0]


def test_negative_zero_divisor(spark):
    frame = spark.createDataFrame([(5.0, -0.0), (5.0, 0.0), (-5.0, -0.0), (0.0, -0.0)], "n double, d double")
    got = [r[0] for r in frame.select(semantics.ieee_div("n", "d")).collect()]
    assert got[:3] == [-math.inf, math.inf, math.inf] and math.isnan(got[3])


def test_hot_cell_is_neither_shuffled_nor_windowed(spark):
    cfg = RunConfig(latest_month=202407, grid_first_period=202404)
    facts = spark.range(300_000, numPartitions=8).select(
        F.lit(C.METRICS[0]).alias("metric"), F.lit(C.ALL_STAFF_GROUP).alias("staff_group"),
        F.when(F.col("id") % 10 < 9, C.PROVIDERS[0]).otherwise(C.PROVIDERS[1]).alias("system"),
        F.lit(202404).alias("period"), F.lit(1.0).alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = overview.main_overview(spark, facts, cfg)
        total = out.filter((F.col("system") == cfg.grid_total_system) & (F.col("period") == 202404)
                           & (F.col("metric") == C.METRICS[0]) & (F.col("staff_group") == C.ALL_STAFF_GROUP))
        assert [r["value"] for r in total.collect()] == [300_000.0]
        plan = overview.grid_left_join(overview.overview_grid(spark, cfg), facts, cfg)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_jdbc_options_need_bounds():
    from staffline.sources import jdbc

    plain = jdbc.read_options("jdbc:x", "t", {"driver": "d", "fetchsize": 10})
    assert plain == {"url": "jdbc:x", "driver": "d", "fetchsize": "10", "query": "SELECT maincode, yearmonth, value, provider FROM t"}
    sliced = jdbc.read_options("jdbc:x", "t", None, "yearmonth", 202001, 202412, 12)
    assert (sliced["lowerBound"], sliced["upperBound"], sliced["numPartitions"]) == ("202001", "202412", "12")
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_options("jdbc:x", "t", None, "yearmonth")
