"""Sinks (replace semantics), contracted union and small operator contracts."""

import tempfile

import pytest
from pyspark.sql import functions as F

from staffline.operators import aggregates, grid, joins, projections, unions
from staffline.plans import measures
from staffline.sources import files, sinks

from conftest import rows


def test_replace_table_overwrites(spark):
    loc = tempfile.mkdtemp(prefix="staffline-pub-")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.replace_table(a, "T", loc)
    sinks.replace_table(a.filter("x = 2"), "T", loc)
    assert rows(sinks.read_published(spark, "T", loc)) == [(2,)]


def test_session_view(spark):
    sinks.publish_session_view(spark.createDataFrame([(1,)], "x int"), "staffline_view")
    assert spark.table("global_temp.staffline_view").count() == 1


def test_csv_round_trip_keeps_nulls(spark):
    path = tempfile.mkdtemp(prefix="staffline-csv-") + "/out"
    df = spark.createDataFrame([("A", 202404, "1", "ROH", None), (None, 202405, None, "ROH", None)],
                               files.FACT_SCHEMA)
    files.write_csv(df, path)
    assert rows(files.read_csv(spark, path)) == rows(df)


def test_contracted_union(spark):
    main = spark.createDataFrame([("a", 1.0)], "k string, v double")
    other = spark.createDataFrame([("b", 2.0, "x")], "k string, v double, extra string")
    out = unions.union_contracted(main, other, "2024-08-05")
    assert out.columns == ["k", "v", "extra", "load_date"]
    assert rows(out.drop("load_date")) == [("a", 1.0, None), ("b", 2.0, "x")]
    # a common column with another type, or no common column: refused
    assert unions.union_contracted(main, spark.createDataFrame([("c", "1")], "k string, v string")) is None
    assert unions.union_contracted(main, spark.createDataFrame([(1,)], "z int")) is None


def test_column_set_algebra(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 3)], "y int, z int")
    assert unions.common_columns(a, b) == ["y"]
    assert unions.all_columns(a, b) == ["x", "y", "z"]
    assert unions.missing_columns(a, ["x", "z"]) == ["z"]


def test_observed_row_count(spark):
    df, obs = aggregates.observe_rows(spark.range(7), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_plan_selector_rejects_bad_combination(spark):
    planned = spark.createDataFrame([(202404, "UHB", "Bank Plan", 1.0)],
                                    "yearmonth int, provider string, type string, plan double")
    with pytest.raises(ValueError, match="either by its type"):
        measures.plan_selector(planned, "Bank Plan", system=True)
    with pytest.raises(ValueError):
        measures.plan_selector(planned)


def test_positional_select_and_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert projections.select_positions(df, [3, 1]).columns == ["c", "a"]
    assert projections.rename_positions(df, [1, 2], ["x", "y"]).columns == ["x", "y", "c"]
    with pytest.raises(KeyError):
        projections.rename(df, {"nope": "z"})


def test_join_suffixes_and_full_outer(spark):
    l = spark.createDataFrame([("k1", "L"), (None, "N")], "k string, g string")
    r = spark.createDataFrame([("k1", "R"), (None, "M"), ("k2", "Q")], "k string, g string")
    out = joins.join_with_suffixes(l, r, ["k"], "left")
    assert out.columns == ["k", "g.x", "g.y"]
    assert rows(out) == sorted([("k1", "L", "R"), (None, "N", "M")], key=repr)
    full = joins.full_outer_coalesced(l.withColumnRenamed("g", "a"), r.withColumnRenamed("g", "b"), ["k"])
    assert rows(full) == sorted([("k1", "L", "R"), (None, "N", "M"), ("k2", None, "Q")], key=repr)


def test_grid_without_cross_join(spark):
    g = grid.dense_grid(grid.systems_frame(spark, ["ICS", "A"]), [("m", "g1"), ("m", "g2")], 202401, 202403)
    assert g.count() == 2 * 2 * 3
    assert g.filter(F.col("period") == 202402).count() == 4


def test_failed_publication_leaves_the_table_as_it_was(spark, tmp_path):
    loc = str(tmp_path)
    good = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.replace_table(good, "T", loc)
    before = sinks.read_published(spark, "T", loc)
    bad = good.select(F.when(F.col("x") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("x")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(bad, "T", loc)
    assert rows(sinks.read_published(spark, "T", loc)) == [(1,), (2,)]
    sinks.replace_table(good.filter("x = 2"), "T", loc)
    assert rows(sinks.read_published(spark, "T", loc)) == [(2,)]
    assert rows(before) == [(1,), (2,)]          # a reader of the version before still finds its files


def test_code_list_broadcast_policy(spark):
    from staffline.plans import lookup
    fact = spark.createDataFrame([("A", 202404, "1", "UHB")], "maincode string, yearmonth int, value string, provider string")
    ref = spark.createDataFrame([(1, "A", "x")], "sheet int, maincode string, reference_sheet string")
    looked = lookup.lookup_all_sheets(fact, ref)
    plan = looked._jdf.queryExecution().optimizedPlan().toString()
    assert "hint" not in plan.lower()          # the size decides, not the caller
    assert looked.count() == 1


def test_lookup_without_broadcast_splits_a_hot_code(spark):
    from staffline.plans import lookup
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        fact = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("maincode"),
            F.lit(202404).alias("yearmonth"), F.col("id").cast("string").alias("value"), F.lit("P").alias("provider"))
        ref = spark.createDataFrame([(1, "HOT", "x"), (1, "C1", "y")], "sheet int, maincode string, reference_sheet string")
        looked = lookup.lookup_all_sheets(fact, ref)
        assert looked.count() >= 180_000
        looked.write.format("noop").mode("overwrite").save()
        agg = looked.groupBy().agg(F.sum("value"))
        agg.collect()
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_skew_safe_full_outer_equals_full_outer(spark):
    l = spark.createDataFrame([("k1", 1, 1.0), ("k1", 1, 2.0), (None, 2, 3.0), ("k3", 3, 4.0), ("k1", None, 9.0)],
                              "k string, m int, a double")
    r = spark.createDataFrame([("k1", 1, "x"), (None, 2, "y"), ("k4", 4, "z"), ("k4", 4, "w"), ("k1", None, "v")],
                              "k string, m int, b string")
    safe = joins.full_outer_coalesced(l, r, ["k", "m"])
    plain = joins.full_outer_coalesced(l, r, ["k", "m"], skew_safe=False)
    assert safe.columns == plain.columns == ["k", "m", "a", "b"]
    assert rows(safe) == rows(plain)
    assert safe.count() == 7


def test_fill_missing_union_widens_by_rank(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2**40,)], "x bigint")
    out = unions.union_fill_missing(a, b)
    assert out.schema["x"].dataType.simpleString() == "bigint"
    assert sorted(r.x for r in out.collect()) == [1, 2**40]


def test_replace_catalog_table(spark):
    sinks.replace_table(spark.createDataFrame([(1,), (2,)], "x int"), "staffline_published_t")
    sinks.replace_table(spark.createDataFrame([(3,)], "x int"), "staffline_published_t")
    assert rows(spark.table("staffline_published_t")) == [(3,)]


def test_contracted_union_reports_counts_without_extra_job(spark):
    main = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    other = spark.createDataFrame([("c", 3.0, "x")], "k string, v double, extra string")
    df, main_rows, result_rows = unions.union_contracted_counted(main, other, "2024-08-05")
    df.write.format("noop").mode("overwrite").save()
    assert main_rows.get["rows"] == 2 and result_rows.get["rows"] == 3
    assert unions.union_contracted_counted(main, spark.createDataFrame([(1,)], "z int")) == (None, None, None)
