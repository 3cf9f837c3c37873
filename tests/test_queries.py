"""Every registered query against its DuckDB oracle, plus plan/volume invariants."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import duck, rows_of  # noqa: E402

from staffline import catalog  # noqa: E402
from staffline.plans import overview  # noqa: E402

SF = "/root/testdata/sf0.001"
#: the queries of the training-data operators have their own tests (tests/llm)
QUERIES = catalog.QUERIES
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQLS)
    assert set(QUERIES) <= set(E.queries())
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    res = con.sql(SQLS[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["metric", "staff_group", "system", "period", "value", "date"]
    assert df.count() > 0


def test_grid_and_pairs(spark):
    assert QUERIES["grid_cross_product"](spark, SF).count() == 8 * 8 * 6 * 48
    assert len(overview.kept_pairs(catalog.CFG)) == 36
    plan = QUERIES["grid_cross_product"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_unpivot_rows_are_twelve_times_input(spark):
    wide = catalog.Model(spark, SF).wide
    assert QUERIES["reshape_months_long"](spark, SF).count() == 12 * wide.count()


def test_overview_ics_is_sum_of_systems(spark):
    o = QUERIES["main_overview"](spark, SF)
    cfg = catalog.CFG
    non = (o.filter(F.col("system") != cfg.grid_total_system)
           .groupBy("metric", "staff_group", "period")
           .agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("s")))
    ics = o.filter(F.col("system") == cfg.grid_total_system)
    j = ics.join(non, ["metric", "staff_group", "period"])
    rates = j.filter(F.col("metric").isin(list(cfg.rate_metrics)))
    assert rates.filter(F.col("value").isNotNull()).count() == 0
    others = j.filter(~F.col("metric").isin(list(cfg.rate_metrics)))
    assert others.filter(F.abs(F.col("value") - F.col("s")) > 1e-9).count() == 0
    assert o.select("metric", "staff_group").distinct().count() == 36


def test_lookup_is_a_broadcast_join_without_fact_shuffle(spark):
    df = QUERIES["join_code_lookup"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan
