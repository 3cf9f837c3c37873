"""What the monthly run and the fill-missing union shuffle and evaluate, and how often."""

import pytest

from staffline import catalog, config as C
from staffline.functions.semantics import to_number
from staffline.plans import lookup
from staffline.sources import standins

from conftest import rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))

    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")

    put("region", [(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    put("nation", [(0, 0), (1, 1)], "n_nationkey int, n_regionkey int")
    put("supplier", [(1, 0), (2, 1)], "s_suppkey long, s_nationkey int")
    put("part", [(1, "STANDARD"), (2, "MEDIUM"), (3, "MEDIUM")], "p_partkey long, p_type string")
    put("customer", [(1, 0, "BUILDING"), (2, 1, "MACHINERY"), (3, 1, None), (None, 0, "BUILDING")],
        "c_custkey long, c_nationkey int, c_mktsegment string")
    put("orders", [(1, 1, "1997-05-01"), (1, 2, "1997-05-02"), (2, 3, "1997-06-01"), (3, None, "1997-06-01"), (None, 1, "1997-06-01")],
        "o_orderkey long, o_custkey long, o_orderdate string")
    put("lineitem", [(k, p, 1, float(q), f, "F", "1997-07-01") for q, (k, p, f) in enumerate(
        [(1, 1, "A"), (1, 2, "R"), (2, 1, "R"), (2, 3, "A"), (3, 1, "A"), (None, 1, "A"), (2, None, "A"), (1, 1, "A")], 1)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate string")
    return d


def plan_of(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def below(lines: list[str], what: str) -> list[str]:
    """The lines of the subtree of the first line that holds ``what``."""
    at = next(k for k, x in enumerate(lines) if what in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    end = next((k for k in range(at + 1, len(lines)) if depth(lines[k]) <= depth(lines[at])), len(lines))
    return lines[at:end]


def test_line_items_are_not_shuffled_for_their_customers(spark, tables):
    """Repeated and null keys join as any inner join does; with large customer tables only the orders are shuffled for them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = standins.order_lines(spark, tables)
        by_customer = below(plan_of(lines), "hashpartitioning(o_custkey")
        assert not any("l_quantity" in x for x in by_customer)
        assert rows(lines, "organisation", "p_type", "l_quantity") == sorted([
            ("ASIA", "STANDARD", 1.0), ("EUROPE 2", "STANDARD", 1.0), ("ASIA", "MEDIUM", 2.0), ("EUROPE 2", "MEDIUM", 2.0),
            ("EUROPE 3", "STANDARD", 3.0), ("EUROPE 3", "MEDIUM", 4.0), ("ASIA", "STANDARD", 8.0), ("EUROPE 2", "STANDARD", 8.0)],
            key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_fact_is_not_shuffled_for_the_code_list(spark, tables):
    """The landed code list has a known size: the lookup broadcasts it, and reads a value once for all its sheets."""
    m = catalog.Model(spark, tables)
    assert not any("hashpartitioning(coalesce(maincode" in x for x in plan_of(m.looked))
    fact = spark.createDataFrame([("A", 1, " 7 ", "p"), (None, 1, "x", "p")], "maincode string, yearmonth int, value string, provider string")
    codes = spark.createDataFrame([(s, c, "r") for s in (1, 2, 20) for c in ("A", None)], "sheet int, maincode string, reference_sheet string")
    looked = lookup.lookup_all_sheets(fact, codes)
    assert rows(looked, "sheet", "maincode", "value") == sorted(
        [(s, c, v) for s in (1, 2, 20) for c, v in (("A", 7.0), (None, 0.0))], key=repr)


def test_sheets_are_written_without_shuffle_or_sort(spark, tmp_path):
    """More sheets than files open at once come back whole; the session's settings are as before."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    frame = spark.range(400, numPartitions=3).selectExpr("id", "cast(id % 25 as int) as sheet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sheets", "sheets")
    try:
        back = lookup.materialize_by_sheet(spark, frame, str(tmp_path / "looked"))
        jobs = tracker.getJobIdsForGroup("sheets")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    assert len(stages) <= 2  # the write, and the listing of what was written
    assert rows(back) == rows(frame)
    assert spark.conf.get(key, None) == before


def test_the_fill_missing_union_evaluates_fact_and_plans_once(spark, tables, monkeypatch):
    taken = []
    for name in ("vacancy_rate", "plan_selector", "wte_by_type"):
        real = getattr(catalog.measures, name)
        monkeypatch.setattr(catalog.measures, name, lambda *a, real=real, **k: taken.extend(x for x in a if hasattr(x, "inputFiles")) or real(*a, **k))
    catalog.union_fill_missing(spark, tables)
    assert len(taken) == 5
    assert not any("lineitem" in f for df in taken for f in df.inputFiles())


def test_a_model_of_some_sheets_and_plans_holds_all_their_rows(spark, tables):
    whole = catalog.Model(spark, tables)
    some = catalog.Model(spark, tables, materialize=True, land_plans=True, sheets=(1, 6), plan_types=(C.SUBSTANTIVE_PLAN,))
    for sheet in (1, 6):
        assert rows(some.t(sheet)) == rows(whole.t(sheet)) != []
    assert rows(some.planned_staff) == rows(whole.planned_staff.filter(f"type = '{C.SUBSTANTIVE_PLAN}'")) != []


def test_whole_numbers_read_as_the_patterns_read_them(spark):
    texts = ["5", " 7 ", "-0", "+3", "1e3", "12d", "1.5", "0x1F", "-inf", "99999999999999999999", "", None, "x", "\t8\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(to_number("t")).collect()]
    assert repr(got) == repr([5.0, 7.0, -0.0, 3.0, 1000.0, 0.0, 1.5, 31.0, float("-inf"), 1e20, 0.0, 0.0, 0.0, 8.0])
