"""Joins of hot keys, sizes of joins before they run, and totals in one pass."""

import collections

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staffline.operators import aggregates, joins

from conftest import rows

KEY = st.one_of(st.none(), st.sampled_from(["a", "b"]))
SIDE = st.lists(st.tuples(KEY, st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 3)), max_size=14)


@settings(max_examples=8, deadline=None)
@given(SIDE, SIDE, st.sampled_from([1, 2, 100]))
def test_split_full_outer_equals_full_outer(spark, left, right, per_split):
    l = spark.createDataFrame(left, "k string, m int, x int")
    r = spark.createDataFrame(right, "kk string, m int, x int").withColumnRenamed("x", "at_left")
    keys = [("k", "kk"), "m"]
    split = joins.full_outer_coalesced(l, r, keys, rows_per_split=per_split)
    plain = joins.full_outer_coalesced(l, r, keys, skew_safe=False)
    assert split.columns == plain.columns == ["k", "m", "x", "at_left"]
    assert rows(split) == rows(plain)
    sizes = joins.fan_out(l, r, keys)
    assert (sizes.agg(F.sum("rows")).first()[0] or 0) == joins.inner_null_safe(l, r, keys).count()


@pytest.mark.parametrize("hot", ["left", "right", "both"])
def test_hot_keys_of_either_side_are_split(spark, hot):
    """90 % of a side in one key: its rows are joined by many tasks, and no task holds more than its share."""
    def side(is_hot, n, name):
        key = F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("c"), F.col("id") % 40)) if is_hot else \
            F.when(F.col("id") == 0, "HOT").otherwise(F.concat(F.lit("c"), F.col("id")))
        return spark.range(n, numPartitions=4).select(key.alias("k"), F.col("id").alias(name))

    l = side(hot in ("left", "both"), 4000 if hot != "right" else 60, "x")
    r = side(hot in ("right", "both"), 4000 if hot == "right" else 100, "y")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.full_outer_coalesced(l, r, ["k"], rows_per_split=200)
        spread = [x["n"] for x in out.where("k = 'HOT' AND x IS NOT NULL AND y IS NOT NULL")
                  .groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert len(spread) >= 6 and max(spread) < 0.45 * sum(spread)
        assert "FullOuter" not in out._jdf.queryExecution().executedPlan().toString()
        n = out.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert n == joins.full_outer_coalesced(l, r, ["k"], skew_safe=False).count()


def test_each_side_of_the_split_join_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for row in it:
            seen.add(1)
            yield row

    l = spark.createDataFrame(spark.sparkContext.parallelize([("a", 1), ("b", 2)], 2).mapPartitions(count), "k string, x int")
    r = spark.createDataFrame([("a", 1), ("c", 3)], "k string, y int")
    assert joins.full_outer_coalesced(l, r, ["k"]).count() == 3
    assert seen.value == 2


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.sampled_from(["p", "q", None]),
                          st.one_of(st.none(), st.integers(0, 4).map(float))), max_size=16))
def test_totals_in_one_pass_equal_two_passes(spark, data):
    df = spark.createDataFrame(data, "yearmonth int, provider string, v double")
    got = rows(aggregates.with_system_total(df, ["v"], "ALL"))
    groups = collections.defaultdict(list)
    for m, _, v in data:
        groups[m].append(v)
    want = data + [(m, "ALL", None if None in vs else float(sum(vs))) for m, vs in groups.items()]
    assert got == sorted(want, key=repr)


def test_totals_read_their_source_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("k", 1, "p", 1.0, "x")] * 3, "kind string, yearmonth int, provider string, v double, note string").write.parquet(path)
    df = spark.read.parquet(path)
    out = aggregates.with_totals(df, ["kind", "yearmonth"], "provider", ["v"], "ALL", flag="total")
    assert rows(out) == sorted([("k", 1, "p", 1.0, "x", False)] * 3 + [("k", 1, "ALL", 3.0, None, True)], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Expand" in plan


def test_repeated_rows_in_blocks(spark):
    df = spark.createDataFrame([("a", 25_001), ("b", 1), ("c", 0), ("d", 10_000)], "k string, n long")
    got = {r["k"]: r["count"] for r in aggregates.repeated(df, "n").groupBy("k").count().collect()}
    assert got == {"a": 25_001, "b": 1, "d": 10_000}
