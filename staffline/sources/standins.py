"""Map the driver's star-schema tables onto the model's inputs.

No workforce data ships with the project, so every model input is *derived by
Spark* from the test tables (so its work grows with them):

==================  ===========================================================
model               stand-in
==================  ===========================================================
provider            the region ``r_name`` of customers of the segment ``TRUST_SEGMENT``
                    (5 regional trusts, the systems of the grid); every other
                    customer is an organisation of its own, ``r_name`` and key
yearmonth           ``yyyymm`` of ``o_orderdate`` (actuals), ``l_shipdate`` (plans)
maincode            ``p_type-<returnflag><linestatus>`` (36 codes); the code
                    ``PROMO-RO`` is NULL in fact and code list alike
value (text)        ``sum(l_quantity)`` as integer text; negative for flag R
code list           the fixed code-list workbook ``REF_BOOK`` below, for every
                    part type present in ``part``
planned staff       ``sum(l_quantity)`` by ship month and plan type, for the trusts by
                    supplier region, for the other organisations by customer
supplied rates      per order month and region: share of status F orders
                    (sickness) and of 1-URGENT orders (turnover), one column
                    per region
planned rates       per ship month and supplier region: share of flag R
                    (sickness) and of status O (turnover) line items
wide submissions    per (region of all customers, fiscal year, sheet, code): 12 monthly
                    sums as text, blank when the month is empty
messy numbers       ``events``: digits of ``props`` padded, suffixed, in exponent,
                    hex or thousands form, ``'n/a'``, ``NaN``, ``-Infinity``,
                    NULL -- by event type and value band
==================  ===========================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import RunConfig
from ..functions.periods import date_to_period
from ..session import session_key

# ---------------------------------------------------------------------------
# Fixed values of the stand-in.
# ---------------------------------------------------------------------------
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
P_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
TRUST_SEGMENT = "BUILDING"                # customers that report through their region's trust
NULL_CODE = ("PROMO", "R", "O")           # (p_type, flag, status) whose code is NULL

STANDIN_CONFIG = RunConfig(
    latest_month=199807,
    fiscal_year_marker=r"[0-9]{2}-[0-9]{2}",
    month_labels=(),
    providers=REGIONS,
    grid_first_period=199504,
    grid_last_period=199903,
    load_date="1998-08-01",
)

# Code-list sheet -> (sheet name, returnflag, linestatus) family of its codes.
SHEET_FAMILIES = {
    1: ("Overall", "A", "F"),
    2: ("Staff Group", "A", "O"),
    3: ("Bank Staff", "N", "F"),
    4: ("Agency Staff", "N", "O"),
    5: ("KPI", "R", "O"),
    6: ("Vacancy", "R", "F"),
    7: ("IR", "A", "F"),
    8: ("AHP IR", "A", "O"),
    9: ("Maternity", "N", "F"),
    10: ("PNA", "N", "O"),
    11: ("PMA", "R", "F"),
    12: ("HCSW", "R", "O"),
}

# Per sheet: p_type -> attribute values (None = blank cell). A list value means
# the code appears in several rows of that sheet.
REF_ATTRIBUTES = {
    1: {  # summary_detail
        "STANDARD": {"summary_detail": C.SUBSTANTIVE_WTE},
        "ECONOMY": {"summary_detail": C.ALL_STAFF_WTE},
        "MEDIUM": {"summary_detail": C.AGENCY_WTE},
        "LARGE": {"summary_detail": C.BANK_WTE},
        "PROMO": {"summary_detail": "Total WTE Medical Staff"},
        "SMALL": {"summary_detail": None},
    },
    2: {  # staff_group, staff_type
        "STANDARD": {"staff_group": "Any Other Staff", "staff_type": C.TOTAL_TYPE},
        "ECONOMY": {"staff_group": "Clinical Support", "staff_type": C.TOTAL_TYPE},
        "MEDIUM": {"staff_group": C.NURSING_GROUP, "staff_type": C.TOTAL_TYPE},
        "LARGE": {"staff_group": "Medical and dental", "staff_type": C.TOTAL_TYPE},
        "PROMO": {"staff_group": "NHS infrastructure support", "staff_type": "Registered"},
        "SMALL": {"staff_group": C.EXCLUDED_SUBSTANTIVE_GROUPS[0], "staff_type": C.TOTAL_TYPE},
    },
    3: {  # bank_agency, staff_group, staff_type
        "STANDARD": {"bank_agency": C.BANK, "staff_group": "Any Other Staff", "staff_type": C.TOTAL_TYPE},
        "ECONOMY": [{"bank_agency": C.BANK, "staff_group": "Clinical Support", "staff_type": C.TOTAL_TYPE},
                    {"bank_agency": C.BANK, "staff_group": "Clinical Support", "staff_type": C.TOTAL_TYPE}],
        "MEDIUM": {"bank_agency": C.BANK, "staff_group": C.NURSING_GROUP, "staff_type": C.TOTAL_TYPE},
        "LARGE": {"bank_agency": C.BANK, "staff_group": "Medical and dental", "staff_type": "Registered"},
        "PROMO": {"bank_agency": C.BANK, "staff_group": "Scientific, therapeutic and technical", "staff_type": C.TOTAL_TYPE},
        "SMALL": {"bank_agency": C.BANK, "staff_group": C.ALL_STAFF_GROUP, "staff_type": C.TOTAL_TYPE},
    },
    4: {
        "STANDARD": {"bank_agency": C.AGENCY, "staff_group": "Any Other Staff", "staff_type": C.TOTAL_TYPE},
        "ECONOMY": {"bank_agency": C.AGENCY, "staff_group": "Clinical Support", "staff_type": C.TOTAL_TYPE},
        "MEDIUM": {"bank_agency": C.AGENCY, "staff_group": C.NURSING_GROUP, "staff_type": C.TOTAL_TYPE},
        "LARGE": {"bank_agency": C.AGENCY, "staff_group": "Medical and dental", "staff_type": C.TOTAL_TYPE},
        "PROMO": {"bank_agency": C.AGENCY, "staff_group": None, "staff_type": C.TOTAL_TYPE},
        "SMALL": {"bank_agency": C.AGENCY, "staff_group": "Ambulance Service Staff", "staff_type": C.TOTAL_TYPE},
    },
    5: {  # workforce_kpi
        "STANDARD": {"workforce_kpi": "Staff Appraisal Rate %"},
        "ECONOMY": {"workforce_kpi": C.TURNOVER_KPI},
        "LARGE": {"workforce_kpi": C.SICKNESS_KPI},
        "MEDIUM": {"workforce_kpi": None},
        "PROMO": {"workforce_kpi": "Mandatory Training Rate %"},
        "SMALL": {"workforce_kpi": "Stability Index %"},
    },
    6: {
        "STANDARD": {"staff_group": C.ALL_ROLES, "staff_type": C.TOTAL_TYPE},
        "PROMO": {"staff_group": C.ALL_ROLES, "staff_type": "Registered"},
        "ECONOMY": {"staff_group": "Clinical Support", "staff_type": C.TOTAL_TYPE},
        "MEDIUM": {"staff_group": C.NURSING_GROUP, "staff_type": C.TOTAL_TYPE},
        "LARGE": {"staff_group": "Medical and dental", "staff_type": C.TOTAL_TYPE},
        "SMALL": {"staff_group": C.EXCLUDED_VACANCY_GROUPS[2], "staff_type": C.TOTAL_TYPE},
    },
    12: {  # measure_detail
        "STANDARD": {"measure_detail": C.HCSW_RATE_MEASURES[0]},
        "ECONOMY": {"measure_detail": C.HCSW_RATE_MEASURES[1]},
        "MEDIUM": {"measure_detail": "HCSW in post WTE"},
        "LARGE": {"measure_detail": None},
        "PROMO": {"measure_detail": "MSW in post WTE"},
        "SMALL": {"measure_detail": "HCSW starters"},
    },
}

PLAN_TYPES = {
    "STANDARD": C.SUBSTANTIVE_PLAN,
    "MEDIUM": C.NURSING_PLAN,
    "ECONOMY": C.AGENCY_PLAN,
    "LARGE": C.BANK_PLAN,
    "PROMO": "Other Plan",
    "SMALL": "Other Plan",
}

# Wide submissions: (flag, status) family -> workbook sheet number. Sheet 10 lies
# outside the read range 3-9.
WIDE_SHEETS = {("A", "F"): 3, ("A", "O"): 4, ("N", "F"): 5, ("N", "O"): 6, ("R", "F"): 9, ("R", "O"): 10}
# Codes replaced in the wide sheets by a blank / a repeated header word.
WIDE_BLANK_CODE = ("PROMO", "R", "F")
WIDE_HEADER_CODE = ("SMALL", "R", "F")
WIDE_MONTH_HEADERS = ("Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec", "Jan", "Feb", "Mar")
REF_COLUMNS = ("reference_sheet", "summary_detail", "staff_group", "staff_type",
               "bank_agency", "workforce_kpi", "measure_detail")


def ref_book_rows() -> list[tuple]:
    """Rows ``(sheet, p_type, flag, status, reference_sheet, ...attributes)``."""
    rows = []
    for sheet, (name, flag, status) in SHEET_FAMILIES.items():
        attrs = REF_ATTRIBUTES.get(sheet, {})
        for p in P_TYPES:
            entries = attrs.get(p, {})
            for entry in entries if isinstance(entries, list) else [entries]:
                vals = {"reference_sheet": name, **entry}
                rows.append((sheet, p, flag, status, *[vals.get(c) for c in REF_COLUMNS]))
    return rows


REF_BOOK_SCHEMA = ("sheet int, p_type string, flag string, status string, " +
                   ", ".join(f"{c} string" for c in REF_COLUMNS))


# ---------------------------------------------------------------------------
# Derivations
# ---------------------------------------------------------------------------

_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One input table; the scan (file listing, footer schema) is set up once per
    application and reused by every query that reads it."""
    key = (session_key(spark), d.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")
    return df


def region_of_nation(spark: SparkSession, d: str) -> DataFrame:
    """nation -> region name; 25 rows by the schema's definition."""
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    return nr.select("n_nationkey", F.col("r_name").alias("provider"))


def customer_provider(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nr = region_of_nation(spark, d)
    return c.join(nr, c.c_nationkey == nr.n_nationkey).select("c_custkey", "provider")


def supplier_provider(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nr = region_of_nation(spark, d)
    return s.join(nr, s.s_nationkey == nr.n_nationkey).select("s_suppkey", "provider")


def organisation(region: str = "provider"):
    """The provider a customer reports as: its region's trust, or itself."""
    own = F.concat_ws(" ", F.col(region), F.col("c_custkey").cast("string"))
    return F.when(F.col("c_mktsegment") == TRUST_SEGMENT, F.col(region)).otherwise(own)


def code_expr(p_type="p_type", flag="l_returnflag", status="l_linestatus"):
    p, f, s = F.col(p_type), F.col(flag), F.col(status)
    is_null = (p == NULL_CODE[0]) & (f == NULL_CODE[1]) & (s == NULL_CODE[2])
    return F.when(is_null, F.lit(None).cast("string")).otherwise(F.concat(p, F.lit("-"), f, s))


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with customer region, organisation, order month and part type.

    Customers are joined to the orders, of which there are a few times fewer than
    line items: where they are too many to broadcast, the orders are shuffled for
    it and not the line items. The 25-row nation->region map is joined last
    (broadcast), so it changes no size estimate of the large joins.
    """
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus",
                                           "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    p = table(spark, d, "part").select("p_partkey", "p_type")
    nr = region_of_nation(spark, d)
    ordered = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey")
    j = (li.join(p, li.l_partkey == p.p_partkey).drop("l_partkey", "p_partkey")
         .join(ordered, li.l_orderkey == ordered.o_orderkey)
         .join(nr, ordered.c_nationkey == nr.n_nationkey))
    return j.select("provider", organisation().alias("organisation"), date_to_period("o_orderdate").alias("yearmonth"),
                    "o_orderdate", "l_shipdate", "p_type", "l_returnflag", "l_linestatus", "l_quantity")


def signed_quantity():
    return F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))


def int_text(c):
    """Whole-number double -> integer text (identical in every SQL engine)."""
    return c.cast("bigint").cast("string")


def fact(spark: SparkSession, d: str) -> DataFrame:
    """``(maincode, yearmonth int, value string, provider)``."""
    ol = order_lines(spark, d)
    agg = ol.groupBy(F.col("organisation").alias("provider"), "yearmonth", "p_type", "l_returnflag", "l_linestatus").agg(
        F.sum(signed_quantity()).alias("q"))
    return agg.select(code_expr().alias("maincode"), "yearmonth", int_text(F.col("q")).alias("value"), "provider")


def ref_book(spark: SparkSession) -> DataFrame:
    """The fixed code-list workbook (created once per application)."""
    key = (session_key(spark), "", "__ref_book__")
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.createDataFrame(ref_book_rows(), REF_BOOK_SCHEMA)
    return df


def _code_from_book():
    return code_expr(p_type="book_p_type", flag="flag", status="status").alias("maincode")


def ref_long(spark: SparkSession, d: str) -> DataFrame:
    """Code list of all sheets: ``(sheet, maincode, reference_sheet, ...)`` for
    every part type present in ``part`` (a code list also lists codes no
    provider reported; those simply find no fact rows)."""
    types = table(spark, d, "part").select("p_type").distinct()
    book = F.broadcast(ref_book(spark))  # a literal frame of len(ref_book_rows()) rows
    j = types.join(book, "p_type")
    return j.select("sheet", code_expr(flag="flag", status="status").alias("maincode"), *REF_COLUMNS)


def supplier_lines(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                                             "l_linestatus", "l_shipdate")
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nr = region_of_nation(spark, d)
    return li.join(s, li.l_suppkey == s.s_suppkey).join(nr, s.s_nationkey == nr.n_nationkey)


def planned_staff_raw(spark: SparkSession, d: str) -> DataFrame:
    """Plan sheet as landed: ``(yearmonth string, provider, type, plan double)``."""
    sl = supplier_lines(spark, d)
    p = table(spark, d, "part").select("p_partkey", "p_type")
    j = sl.join(p, sl.l_partkey == p.p_partkey)
    trusts = j.select("provider", "l_shipdate", "p_type", "l_quantity")
    others = (order_lines(spark, d).where(F.col("organisation") != F.col("provider"))
              .select(F.col("organisation").alias("provider"), "l_shipdate", "p_type", "l_quantity"))
    ptype = F.create_map(*[F.lit(x) for kv in PLAN_TYPES.items() for x in kv])[F.col("p_type")]
    agg = trusts.unionByName(others).groupBy("provider", date_to_period("l_shipdate").alias("ym"), ptype.alias("type")).agg(
        F.sum("l_quantity").cast("double").alias("plan"))
    return agg.select(F.col("ym").cast("string").alias("yearmonth"), "provider", "type", "plan")


def _share(cond, within=None):
    """Share of rows meeting ``cond`` (within a sub-population); NULL when empty."""
    base = F.lit(True) if within is None else within
    n = F.count_if(base)
    return F.when(n == 0, F.lit(None).cast("double")).otherwise(F.count_if(base & cond) / n)


def supplied_rates_wide(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """``(date, AFRICA, AMERICA, ASIA, EUROPE, MIDDLE EAST)`` monthly rates."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    cp = customer_provider(spark, d)
    j = o.join(cp, o.o_custkey == cp.c_custkey)
    cond = (F.col("o_orderstatus") == "F") if kind == "sickness" else (F.col("o_orderpriority") == "1-URGENT")
    return j.groupBy(F.trunc("o_orderdate", "month").cast("date").alias("date")).agg(
        *[_share(cond, F.col("provider") == r).alias(r) for r in REGIONS])


def planned_rates_raw(spark: SparkSession, d: str) -> DataFrame:
    """Planned sickness & turnover: ``(date, yearmonth string, provider, type, plan)``."""
    sl = supplier_lines(spark, d)
    agg = sl.groupBy(F.trunc("l_shipdate", "month").cast("date").alias("date"), "provider").agg(
        _share(F.col("l_returnflag") == "R").alias("Staff Sickness Rate"),
        _share(F.col("l_linestatus") == "O").alias("Staff Turnover Rate"))
    long = agg.unpivot(["date", "provider"], ["Staff Sickness Rate", "Staff Turnover Rate"], "type", "plan")
    return long.select("date", date_to_period("date").cast("string").alias("yearmonth"), "provider", "type", "plan")


def fiscal_marker(fy):
    yy = (fy % 100).cast("string")
    nx = ((fy + 1) % 100).cast("string")
    return F.concat(F.lpad(yy, 2, "0"), F.lit("-"), F.lpad(nx, 2, "0"))


def wide_submissions(spark: SparkSession, d: str) -> DataFrame:
    """Wide monthly returns in the workbook's positional layout plus the landing
    keys ``submission`` (workbook name) and ``sheet_no``."""
    ol = order_lines(spark, d)
    m = F.month("o_orderdate")
    ol = ol.withColumns({
        "fy": (F.year("o_orderdate") - F.when(m < 4, 1).otherwise(0)).cast("int"),
        "fmonth": ((m + 8) % 12 + 1).cast("int"),
    })
    months = [F.sum(F.when(F.col("fmonth") == i, signed_quantity())).alias(f"m{i}") for i in range(1, 13)]
    agg = ol.groupBy("provider", "fy", "p_type", "l_returnflag", "l_linestatus").agg(
        *months, F.sum(signed_quantity()).alias("ytd"))
    sheet = F.create_map(*[F.lit(x) for (fl, st), n in WIDE_SHEETS.items() for x in (fl + st, n)])[
        F.concat("l_returnflag", "l_linestatus")]
    p, fl, st = F.col("p_type"), F.col("l_returnflag"), F.col("l_linestatus")
    code = (F.when((p == WIDE_BLANK_CODE[0]) & (fl == WIDE_BLANK_CODE[1]) & (st == WIDE_BLANK_CODE[2]),
                   F.lit(None).cast("string"))
            .when((p == WIDE_HEADER_CODE[0]) & (fl == WIDE_HEADER_CODE[1]) & (st == WIDE_HEADER_CODE[2]),
                  F.lit("Subcode"))
            .otherwise(F.concat(p, F.lit("-"), fl, st)))
    marker = fiscal_marker(F.col("fy"))
    return agg.select(
        F.col("provider").alias("Organisation"),
        marker.alias("Fiscal Year"),
        F.concat(F.lit("Sheet "), sheet.cast("string")).alias("Sheet"),
        p.alias("Staff Group"),
        F.concat(p, F.lit(" "), fl, st).alias("Description"),
        *[int_text(F.col(f"m{i}")).alias(h) for i, h in enumerate(WIDE_MONTH_HEADERS, start=1)],
        int_text(F.col("ytd")).alias("Year To Date"),
        code.alias("Maincode"),
        F.concat(F.col("provider"), F.lit(" "), marker, F.lit(" submission")).alias("submission"),
        sheet.alias("sheet_no"),
    )


def messy_values(spark: SparkSession, d: str) -> DataFrame:
    """``(event_id, event_type, raw)`` text values in several broken formats:
    the digits of ``props`` padded, suffixed, in exponent, hexadecimal or
    thousands-separated form, or replaced by ``n/a``, ``NaN``, infinity or a
    blank, chosen by event type and value band."""
    e = table(spark, d, "events").select("event_id", "event_type", "props", "value")
    digits = F.regexp_extract("props", "[0-9]+", 0)
    t, v = F.col("event_type"), F.col("value")
    purchase = (F.when(v < 10, F.concat(F.lit("0x"), digits))
                .when(v < 20, F.lit("-Infinity"))
                .when(v < 30, F.concat(F.lit("1,"), digits))
                .when(v < 40, F.lit("NaN"))
                .otherwise(F.concat(digits, F.lit("e1"))))
    raw = (F.when(t == "error", F.lit("n/a"))
           .when(t == "signup", F.lit(None).cast("string"))
           .when(t == "view", F.concat(F.lit(" "), digits, F.lit(" ")))
           .when(t == "click", F.concat(digits, F.lit("d")))
           .otherwise(purchase))
    return e.select("event_id", "event_type", raw.alias("raw"))
