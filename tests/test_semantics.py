"""One test per semantic rule (missing values, division, membership, unions)."""

import math

import pytest
from pyspark.sql import functions as F

from staffline.functions import periods, semantics, text
from staffline.operators import filters, joins, reshape, unions

from conftest import rows


def test_n1_null_keys_match_in_joins(spark):
    fact = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "maincode string, v double")
    ref = spark.createDataFrame([(None, "blank"), ("A", "a")], "maincode string, label string")
    out = joins.inner_null_safe(fact, ref, ["maincode"])
    assert rows(out) == sorted([(None, 1.0, "blank"), ("A", 2.0, "a")], key=repr)
    # and it is still an equi-join (no nested loop)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_n2_negated_membership_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(filters.not_in_keep_null(df, "k", ["a"])) == sorted([("b",), (None,)], key=repr)
    # F3 and F4 are exact complements, NULL included
    a, b = filters.split_in(df, "k", ["a"])
    assert a.count() + b.count() == df.count()


def test_n3_filter_drops_null_conditions(spark):
    df = spark.createDataFrame([("x",), (None,)], "k string")
    assert filters.not_equal(df, "k", "y").count() == 1
    assert filters.conjunction(df, k="x").count() == 1


def test_n4_strict_sum_poisoned_by_one_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0)], "k string, v double")
    out = dict(df.groupBy("k").agg(semantics.strict_sum("v").alias("s")).collect())
    assert out["a"] is None and out["b"] == 5.0


def test_n5_sum_na_rm_ignores_null_and_nan_and_empty_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 2.0), ("b", None)], "k string, v double")
    out = dict(df.groupBy("k").agg(semantics.sum_na_rm("v").alias("s")).collect())
    assert out == {"a": 0.0, "b": 2.0}


def test_n6_ieee_division(spark):
    df = spark.createDataFrame([(5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 1.0), (1.0, None)],
                               "n double, d double")
    got = [r[0] for r in df.select(semantics.ieee_div("n", "d")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == 2.0
    assert got[4] is None and got[5] is None


def test_n7_nan_to_null_keeps_inf(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (math.inf, "y"), (1.0, "z")], "v double, s string")
    out = semantics.nan_to_null_all(df).collect()
    assert out[0]["v"] is None and out[1]["v"] == math.inf and out[2]["v"] == 1.0 and out[0]["s"] == "x"


def test_n8_lenient_number_parsing(spark):
    vals = ["12", " 12 ", "1e3", "1,234", "n/a", "", "NaN", "12d", None,
            "Inf", "-inf", "Infinity", "0x1A", "-0X10", "+7", ".5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(semantics.to_number("s")).collect()]
    assert got == [12.0, 12.0, 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0,
                   math.inf, -math.inf, math.inf, 26.0, -16.0, 7.0, 0.5]


def test_n9_unpivot_keeps_blank_cells(spark):
    df = spark.createDataFrame([("A", "1", None)], "code string, m1 string, m2 string")
    out = reshape.months_long(df, ["code"], ["m1", "m2"], labels=[202404, 202405])
    assert rows(out) == sorted([("A", 202404, "1"), ("A", 202405, None)], key=repr)


def test_n10_mixed_types_rejected_before_run(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([("s",)], "x string")
    with pytest.raises(unions.SchemaMismatch):
        unions.union_fill_missing(a, b)


def test_n11_strict_union_requires_same_names(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([("b", 2)], "y string, x int")
    assert rows(unions.union_strict(a, b)) == [(1, "a"), (2, "b")]
    c = spark.createDataFrame([(3,)], "x int")
    with pytest.raises(unions.SchemaMismatch):
        unions.union_strict(a, c)


def test_n12_fill_missing_union_widens_numbers(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([(2.5,)], "x double")
    out = unions.union_fill_missing(a, b)
    assert dict((f.name, f.dataType.simpleString()) for f in out.schema.fields) == {"x": "double", "y": "string"}
    assert rows(out) == sorted([(1.0, "a"), (2.5, None)], key=repr)


def test_n13_many_to_many_fan_out_kept(spark):
    fact = spark.createDataFrame([("A", 1.0)], "maincode string, v double")
    ref = spark.createDataFrame([("A", "x"), ("A", "x")], "maincode string, label string")
    assert joins.inner_null_safe(fact, ref, ["maincode"]).count() == 2


def test_n14_period_compared_as_int(spark):
    df = spark.createDataFrame([("202407",), ("202408",), (None,)], "ym string")
    out = filters.cutoff(df.withColumn("ym", periods.period_cast("ym")), 202407, "ym")
    assert rows(out) == [(202407,)]


def test_n16_case_when_without_default(spark):
    from staffline.plans.measures import kpi_type
    from staffline import config as C
    df = spark.createDataFrame([(C.TURNOVER_KPI,), (C.SICKNESS_KPI,), ("other",), (None,)], "workforce_kpi string")
    got = [r[0] for r in df.select(kpi_type()).collect()]
    assert got == [C.TURNOVER_TYPE, C.SICKNESS_TYPE, None, None]


def test_period_helpers(spark):
    df = spark.createDataFrame([("2024-07-15",)], "d string").select(F.to_date("d").alias("d"))
    r = df.select(periods.date_to_period("d").alias("p"),
                  periods.period_to_date(F.lit(202407)).alias("first"),
                  F.size(periods.period_sequence(F.lit(202104), F.lit(202503))).alias("n"),
                  periods.fiscal_period(F.lit(2024), F.lit(12)).alias("mar")).first()
    assert r["p"] == 202407 and str(r["first"]) == "2024-07-01" and r["n"] == 48 and r["mar"] == 202503


def test_provider_from_file_name(spark):
    df = spark.createDataFrame([("ROH 24-25 M04.csv",), ("NoMarker.csv",), ("BWCH  24-25.xlsx",)], "f string")
    got = [r[0] for r in df.select(text.provider_from_name("f", "24-25")).collect()]
    assert got == ["ROH", "NoMarker.csv", "BWCH"]


def test_n15_results_are_multisets(spark):
    # no operator sorts; a repartitioned input gives the same multiset
    a = spark.createDataFrame([(i % 3, float(i)) for i in range(30)], "k int, v double")
    b = a.repartition(7)
    agg = lambda d: rows(d.groupBy("k").agg(semantics.strict_sum("v").alias("s")))
    assert agg(a) == agg(b)


def test_n17_rates_are_fractions(spark):
    from staffline.plans import measures
    overall = spark.createDataFrame([("S", 202404, 90.0, "P", "Total WTE Substantive Staff")],
                                    "maincode string, yearmonth int, value double, provider string, "
                                    "summary_detail string")
    vacancy = spark.createDataFrame([("V", 202404, 10.0, "P", "All Roles", "Total")],
                                    "maincode string, yearmonth int, value double, provider string, "
                                    "staff_group string, staff_type string")
    r = measures.vacancy_rate(overall, vacancy).first()
    assert r.rate == 0.1 and r.total == 100.0
