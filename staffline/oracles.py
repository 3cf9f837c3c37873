"""Independent SQL formulations (DuckDB dialect) of every registered query.

They follow the original step-by-step formulation where it differs from the
Spark plan (twelve slice joins and a roll-up self-join for the overview, a cut
after the full joins), so the oracle also checks that each redesign is
equivalent. The star-schema tables are pre-registered views.
"""

from __future__ import annotations

from . import config as C
from .sources import standins as S

L = S.STANDIN_CONFIG.latest_month
LOAD = S.STANDIN_CONFIG.load_date
SYS = C.SYSTEM_TOTAL_LABEL
ICS = C.GRID_TOTAL_SYSTEM


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def div(n: str, d: str) -> str:
    """IEEE division: x/0 = +-inf, 0/0 = nan, NULL operands = NULL."""
    n, d = f"CAST({n} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    return (f"(CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL WHEN {d} = 0 THEN "
            f"(CASE WHEN isnan({n}) THEN 'nan'::DOUBLE WHEN {n} > 0 THEN 'inf'::DOUBLE "
            f"WHEN {n} < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END) ELSE {n} / {d} END)")


def nan_null(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def strict_sum(x: str) -> str:
    return f"(CASE WHEN count({x}) < count(*) THEN NULL ELSE CAST(sum({x}) AS DOUBLE) END)"


def sum_na_rm(x: str) -> str:
    return f"coalesce(sum({nan_null(x)}), 0.0)"


def to_number(v: str) -> str:
    t = f"trim({v})"
    p = (f"(CASE WHEN regexp_full_match({t}, '[+-]?0[xX][0-9a-fA-F]+') THEN "
         f"(CASE WHEN starts_with({t}, '-') THEN -1.0 ELSE 1.0 END) * "
         f"CAST(TRY_CAST(ltrim({t}, '+-') AS BIGINT) AS DOUBLE) "
         f"WHEN regexp_full_match(lower({t}), '[+-]?inf(inity)?') THEN TRY_CAST({t} AS DOUBLE) "
         f"WHEN regexp_matches({t}, '[dDfF]$') THEN NULL ELSE TRY_CAST({t} AS DOUBLE) END)")
    return f"coalesce(CASE WHEN isnan({p}) THEN 0.0 ELSE {p} END, 0.0)"


def period(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


def code(p: str, f: str, s: str) -> str:
    np_, nf, ns = S.NULL_CODE
    return (f"(CASE WHEN {p} = {lit(np_)} AND {f} = {lit(nf)} AND {s} = {lit(ns)} THEN NULL "
            f"ELSE {p} || '-' || {f} || {s} END)")


def share(cond: str, within: str = "TRUE") -> str:
    return (f"(CASE WHEN count_if({within}) = 0 THEN NULL "
            f"ELSE count_if(({within}) AND ({cond})) / count_if({within}) END)")


def nsafe(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k2}" for k, k2 in
                        ((k, k) if isinstance(k, str) else k for k in keys))


REF_COLS = S.REF_COLUMNS


def _ref_book_values() -> str:
    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in S.ref_book_rows())
    cols = "sheet, p_type, flag, status, " + ", ".join(REF_COLS)
    return f"SELECT * FROM (VALUES {rows}) v({cols})"


def _plan_type_case(col: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in S.PLAN_TYPES.items())
    return f"(CASE {col} {whens} END)"


def _wide_sheet_case() -> str:
    whens = " ".join(f"WHEN {lit(f + s)} THEN {n}" for (f, s), n in S.WIDE_SHEETS.items())
    return f"(CASE l_returnflag || l_linestatus {whens} END)"


def _wide_code() -> str:
    bp, bf, bs = S.WIDE_BLANK_CODE
    hp, hf, hs = S.WIDE_HEADER_CODE
    return (f"(CASE WHEN p_type = {lit(bp)} AND l_returnflag = {lit(bf)} AND l_linestatus = {lit(bs)} THEN NULL "
            f"WHEN p_type = {lit(hp)} AND l_returnflag = {lit(hf)} AND l_linestatus = {lit(hs)} THEN 'Subcode' "
            f"ELSE p_type || '-' || l_returnflag || l_linestatus END)")


def _int_text(x: str) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"


MONTHS = S.WIDE_MONTH_HEADERS
MARKER = ("lpad(CAST(fy % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST((fy + 1) % 100 AS VARCHAR), 2, '0')")
FY_FROM_NAME = ("(CASE WHEN CAST(NULLIF(regexp_extract(submission, '([0-9]{2})-[0-9]{2}', 1), '') AS INTEGER) >= 50 "
                "THEN 1900 ELSE 2000 END + CAST(NULLIF(regexp_extract(submission, '([0-9]{2})-[0-9]{2}', 1), '') "
                "AS INTEGER))")
PROVIDER_FROM_NAME = "trim(string_split_regex({0}, '[0-9]{{2}}-[0-9]{{2}}')[1])"


def _fiscal_period(fy: str, i: str) -> str:
    return f"CAST(CASE WHEN {i} <= 9 THEN {fy} * 100 + {i} + 3 ELSE ({fy} + 1) * 100 + {i} - 9 END AS INTEGER)"


def _month_list() -> str:
    return "[" + ", ".join(f'w."{m}"' for m in MONTHS) + "]"


def _rate(vac: str, sub: str, label: str) -> str:
    return (f"SELECT v.provider, v.yearmonth, v.vacancy, s.substantive, v.vacancy + s.substantive AS total, "
            f"{div('v.vacancy', 'v.vacancy + s.substantive')} AS rate, {lit(label)} AS type "
            f"FROM {vac} v JOIN {sub} s ON {nsafe('v', 's', ['provider', 'yearmonth'])}")


def _sys(rel: str, col: str) -> str:
    return f"SELECT yearmonth, {strict_sum(col)} AS {col}, {lit(SYS)} AS provider FROM {rel} GROUP BY yearmonth"


def _pva(v: str, p: str) -> str:
    return (f"SELECT coalesce(a.yearmonth, p.yearmonth) AS yearmonth, coalesce(a.provider, p.provider) AS provider, "
            f"a.substantive, p.plan, a.substantive - p.plan AS difference_wte, "
            f"{div('a.substantive - p.plan', 'p.plan')} AS percentage_difference, a.rate AS vacancy_rate "
            f"FROM {v} a FULL JOIN {p} p ON {nsafe('a', 'p', ['provider', 'yearmonth'])}")


def _avp(a: str, p: str) -> str:
    return (f"SELECT coalesce(a.provider, p.provider) AS provider, coalesce(a.yearmonth, p.yearmonth) AS yearmonth, "
            f"a.substantive, p.plan, a.substantive - p.plan AS difference_wte, "
            f"{div('a.substantive - p.plan', 'p.plan')} AS percentage_difference "
            f"FROM {a} a FULL JOIN {p} p ON {nsafe('a', 'p', ['provider', 'yearmonth'])}")


def _nan_cols(rel: str, cols, doubles) -> str:
    return "SELECT " + ", ".join(f"{nan_null(c)} AS {c}" if c in doubles else c for c in cols) + f" FROM {rel}"


def _st_part(kind: str) -> str:
    wide = f"{kind}_wide"
    kpi, mc, sheet = ((C.SICKNESS_KPI, C.SICKNESS_CODE, C.SICKNESS_SHEET) if kind == "sickness"
                      else (C.TURNOVER_KPI, C.TURNOVER_CODE, C.TURNOVER_SHEET))
    return " UNION ALL ".join(
        f"SELECT {lit(mc)} AS maincode, {period('date')} AS yearmonth, CAST(\"{r}\" AS DOUBLE) AS value, "
        f"{lit(r)} AS provider, {lit(kpi)} AS workforce_kpi, {lit(sheet)} AS reference_sheet FROM {wide}"
        for r in S.REGIONS)


def _slice(name: str, metric: str, group_pred: str, src: str, keys3: bool = False) -> str:
    on = "g.system = x.provider AND g.period = x.yearmonth" + (" AND g.staff_group = x.staff_group" if keys3 else "")
    return (f"{name} AS (SELECT g.metric, g.staff_group, g.system, g.period, CAST(x.value AS DOUBLE) AS value "
            f"FROM (SELECT * FROM grid WHERE metric = {lit(metric)} AND {group_pred}) g "
            f"LEFT JOIN ({src}) x ON {on})")


ALL = f"staff_group = {lit(C.ALL_STAFF_GROUP)}"
NOT_ALL = f"NOT staff_group = {lit(C.ALL_STAFF_GROUP)}"
M = C.METRICS


def _ctes() -> list[tuple[str, str]]:
    t = []
    add = lambda name, body: t.append((name, body))
    add("cust_prov", "SELECT c_custkey, r_name AS provider, "
        f"CASE WHEN c_mktsegment = {lit(S.TRUST_SEGMENT)} THEN r_name ELSE r_name || ' ' || c_custkey END AS organisation "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey")
    add("supp_prov", "SELECT s_suppkey, r_name AS provider FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey")
    add("order_lines", f"SELECT cp.provider, cp.organisation, {period('o_orderdate')} AS yearmonth, o_orderdate, p_type, "
        "l_shipdate, l_returnflag, l_linestatus, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
        "JOIN cust_prov cp ON o_custkey = cp.c_custkey JOIN part ON l_partkey = p_partkey")
    signed_sum = "sum(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END)"
    add("fact", f"SELECT {code('p_type', 'l_returnflag', 'l_linestatus')} AS maincode, yearmonth, "
        f"{_int_text(signed_sum)} AS value, organisation AS provider "
        "FROM order_lines GROUP BY organisation, yearmonth, p_type, l_returnflag, l_linestatus")
    add("ref_book", _ref_book_values())
    add("part_types", "SELECT DISTINCT p_type FROM part")
    add("ref_long", f"SELECT b.sheet, {code('b.p_type', 'b.flag', 'b.status')} AS maincode, "
        + ", ".join(f"b.{c}" for c in REF_COLS) + " FROM part_types t JOIN ref_book b ON t.p_type = b.p_type")
    add("joined", "SELECT f.maincode, f.yearmonth, f.value, f.provider, r.sheet, " + ", ".join(f"r.{c}" for c in REF_COLS)
        + " FROM fact f JOIN ref_long r ON f.maincode IS NOT DISTINCT FROM r.maincode")
    add("looked", f"SELECT maincode, yearmonth, {to_number('value')} AS value, provider, sheet, "
        + ", ".join(REF_COLS) + " FROM joined")
    for sheet, cols in C.SHEET_COLUMNS.items():
        value = "abs(value) AS value" if sheet == C.SHEET_VACANCY else "value"
        add(f"t{sheet}", f"SELECT maincode, yearmonth, {value}, provider, {', '.join(cols)} FROM looked "
            f"WHERE sheet = {sheet}")
    add("t13", "SELECT * FROM t3 UNION ALL SELECT * FROM t4")
    # plans
    add("planned_raw", f"SELECT CAST(ym AS VARCHAR) AS yearmonth, provider, type, plan FROM ("
        f"SELECT provider, {period('l_shipdate')} AS ym, {_plan_type_case('p_type')} AS type, "
        "CAST(sum(l_quantity) AS DOUBLE) AS plan FROM (SELECT sp.provider, l_shipdate, p_type, l_quantity "
        "FROM lineitem JOIN supp_prov sp ON l_suppkey = sp.s_suppkey JOIN part ON l_partkey = p_partkey UNION ALL "
        "SELECT organisation, l_shipdate, p_type, l_quantity FROM order_lines WHERE organisation <> provider) "
        "GROUP BY 1, 2, 3)")
    add("planned", "SELECT TRY_CAST(trim(yearmonth) AS INTEGER) AS yearmonth, provider, type, plan FROM planned_raw")
    # supplied and planned rates
    add("orders_prov", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, cp.provider, o_orderstatus, "
        "o_orderpriority FROM orders JOIN cust_prov cp ON o_custkey = cp.c_custkey")
    for kind, cond in (("sickness", "o_orderstatus = 'F'"), ("turnover", "o_orderpriority = '1-URGENT'")):
        cols = ", ".join(f"{share(cond, f'provider = {lit(r)}')} AS \"{r}\"" for r in S.REGIONS)
        add(f"{kind}_wide", f"SELECT date, {cols} FROM orders_prov GROUP BY date")
    add("rates_plan", "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sp.provider, "
        f"{share(chr(39).join(['l_returnflag = ', 'R', '']))} AS sick, "
        f"{share(chr(39).join(['l_linestatus = ', 'O', '']))} AS turn "
        "FROM lineitem JOIN supp_prov sp ON l_suppkey = sp.s_suppkey GROUP BY 1, 2")
    add("planned_rates", f"SELECT date, {period('date')} AS yearmonth, provider, 'Staff Sickness Rate' AS type, "
        f"sick AS plan FROM rates_plan UNION ALL SELECT date, {period('date')}, provider, 'Staff Turnover Rate', "
        "turn FROM rates_plan")
    add("st_long", _st_part("sickness") + " UNION ALL " + _st_part("turnover"))
    add("kpi_kept", f"SELECT * FROM t5 WHERE NOT coalesce(workforce_kpi IN {in_list([C.TURNOVER_KPI, C.SICKNESS_KPI])},"
        " false)")
    add("kpi_all", "SELECT * FROM kpi_kept UNION ALL SELECT * FROM st_long")
    add("st_actual", "SELECT provider, yearmonth, reference_sheet, value AS actual FROM st_long")
    add("st_joined", "SELECT a.provider, a.yearmonth, a.reference_sheet, a.actual, p.plan FROM st_actual a "
        f"LEFT JOIN planned_rates p ON {nsafe('a', 'p', ['provider', 'yearmonth', ('reference_sheet', 'type')])}")
    add("variance_all", " UNION ALL ".join(
        f"SELECT provider, yearmonth, reference_sheet, {lit(lab)} AS metric, CAST({expr} AS DOUBLE) AS value "
        "FROM st_joined" for lab, expr in (("Actual", "actual"), ("Plan", "plan"), ("Variance", "actual - plan"),
                                           ("% Difference", div("actual - plan", "plan")))))
    add("variance", f"SELECT * FROM variance_all WHERE yearmonth <= {L}")
    # vacancies
    add("vac_main", f"SELECT yearmonth, value AS vacancy, provider FROM t6 WHERE staff_group = {lit(C.ALL_ROLES)}")
    add("sub_main", "SELECT yearmonth, value AS substantive, provider FROM t1 "
        f"WHERE summary_detail = {lit(C.SUBSTANTIVE_WTE)}")
    grp = f"staff_group = {lit(C.NURSING_GROUP)} AND staff_type = {lit(C.TOTAL_TYPE)}"
    add("vac_grp", f"SELECT yearmonth, value AS vacancy, provider FROM t6 WHERE {grp}")
    add("sub_grp", f"SELECT yearmonth, value AS substantive, provider FROM t2 WHERE {grp}")
    add("main_vacancy", _rate("vac_main", "sub_main", C.MAIN_VACANCY))
    add("nursing_vacancy", _rate("vac_grp", "sub_grp", C.NURSING_VACANCY))
    add("vac_main_sys", _sys("vac_main", "vacancy"))
    add("sub_main_sys", _sys("sub_main", "substantive"))
    add("vac_grp_sys", _sys("vac_grp", "vacancy"))
    add("sub_grp_sys", _sys("sub_grp", "substantive"))
    add("main_vacancy_sys", _rate("vac_main_sys", "sub_main_sys", C.MAIN_VACANCY))
    add("nursing_vacancy_sys", _rate("vac_grp_sys", "sub_grp_sys", C.NURSING_VACANCY))
    add("vac_stack", "SELECT * FROM main_vacancy UNION ALL SELECT * FROM nursing_vacancy UNION ALL "
        "SELECT * FROM main_vacancy_sys UNION ALL SELECT * FROM nursing_vacancy_sys")
    add("vacancies", _nan_cols("vac_stack", ["provider", "yearmonth", "vacancy", "substantive", "total", "rate", "type"],
                               {"vacancy", "substantive", "total", "rate"}))
    # plans vs actual
    for key, ptype in (("main", C.SUBSTANTIVE_PLAN), ("nursing", C.NURSING_PLAN), ("agency", C.AGENCY_PLAN),
                       ("bank", C.BANK_PLAN)):
        add(f"{key}_plan", f"SELECT yearmonth, provider, plan FROM planned WHERE type = {lit(ptype)}")
        add(f"{key}_plan_sys", f"SELECT yearmonth, {lit(SYS)} AS provider, {strict_sum('plan')} AS plan "
            f"FROM {key}_plan GROUP BY yearmonth")
    for key, detail in (("agency", C.AGENCY_WTE), ("bank", C.BANK_WTE)):
        add(f"wte_{key}", f"SELECT yearmonth, value AS substantive, provider FROM t1 WHERE summary_detail = {lit(detail)}")
        add(f"wte_{key}_sys", _sys(f"wte_{key}", "substantive"))
    add("wte_sub", f"SELECT yearmonth, value AS substantive, provider FROM t1 WHERE summary_detail = "
        f"{lit(C.SUBSTANTIVE_WTE)}")
    cols8 = "yearmonth, provider, substantive, plan, difference_wte, percentage_difference"
    add("staffing_stack",
        f"SELECT *, {lit(C.STAFFING_VS_PLAN_SUBSTANTIVE)} AS type FROM ({_pva('main_vacancy', 'main_plan')} UNION ALL "
        f"{_pva('main_vacancy_sys', 'main_plan_sys')}) UNION ALL "
        f"SELECT *, {lit(C.STAFFING_VS_PLAN_NURSING)} FROM ({_pva('nursing_vacancy', 'nursing_plan')} UNION ALL "
        f"{_pva('nursing_vacancy_sys', 'nursing_plan_sys')}) UNION ALL "
        f"SELECT {cols8}, CAST(NULL AS DOUBLE), {lit(C.AGENCY_ACTUAL_VS_PLAN)} FROM ("
        f"{_avp('wte_agency', 'agency_plan')} UNION ALL {_avp('wte_agency_sys', 'agency_plan_sys')}) UNION ALL "
        f"SELECT {cols8}, CAST(NULL AS DOUBLE), {lit(C.BANK_ACTUAL_VS_PLAN)} FROM ("
        f"{_avp('wte_bank', 'bank_plan')} UNION ALL {_avp('wte_bank_sys', 'bank_plan_sys')})")
    add("staffing_all", _nan_cols(
        "staffing_stack", ["yearmonth", "provider", "substantive", "plan", "difference_wte", "percentage_difference",
                           "vacancy_rate", "type"],
        {"substantive", "plan", "difference_wte", "percentage_difference", "vacancy_rate"})
        + f" WHERE yearmonth <= {L}")
    # wide submissions and their ingest
    months = ", ".join(f"sum(CASE WHEN fmonth = {i} THEN q END) AS m{i}" for i in range(1, 13))
    add("wide_base", "SELECT provider, CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END "
        "AS INTEGER) AS fy, CAST((month(o_orderdate) + 8) % 12 + 1 AS INTEGER) AS fmonth, p_type, l_returnflag, "
        "l_linestatus, CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS q FROM order_lines")
    add("wide_agg", f"SELECT provider, fy, p_type, l_returnflag, l_linestatus, {months}, sum(q) AS ytd "
        "FROM wide_base GROUP BY provider, fy, p_type, l_returnflag, l_linestatus")
    mcols = ", ".join(f'{_int_text(f"m{i}")} AS "{h}"' for i, h in enumerate(MONTHS, start=1))
    add("wide", f'SELECT provider AS "Organisation", {MARKER} AS "Fiscal Year", '
        f"'Sheet ' || CAST({_wide_sheet_case()} AS VARCHAR) AS \"Sheet\", p_type AS \"Staff Group\", "
        f"p_type || ' ' || l_returnflag || l_linestatus AS \"Description\", {mcols}, "
        f"{_int_text('ytd')} AS \"Year To Date\", {_wide_code()} AS \"Maincode\", "
        f"provider || ' ' || {MARKER} || ' submission' AS submission, {_wide_sheet_case()} AS sheet_no FROM wide_agg")
    add("wide_long", f'SELECT w.submission, w.sheet_no, w."Maincode", CAST(r.i AS INTEGER) AS fiscal_month, '
        f"{_month_list()}[r.i] AS value FROM wide w CROSS JOIN (SELECT range AS i FROM range(1, 13)) r")
    add("ingest_all", f'SELECT "Maincode" AS maincode, {_fiscal_period(FY_FROM_NAME, "fiscal_month")} AS yearmonth, '
        f"value, {PROVIDER_FROM_NAME.format('submission')} AS provider, DATE '{LOAD}' AS load_date FROM wide_long "
        f"WHERE sheet_no BETWEEN {C.SUBMISSION_SHEETS[0]} AND {C.SUBMISSION_SHEETS[1]} "
        f"AND \"Maincode\" IS NOT NULL AND \"Maincode\" NOT IN {in_list(C.HEADER_WORDS)}")
    add("ingest", f"SELECT * FROM ingest_all WHERE yearmonth <= {L}")
    # overview, as twelve slice joins and a roll-up self-join
    cfg = S.STANDIN_CONFIG
    add("grid_metrics", "SELECT * FROM (VALUES " + ", ".join(f"({lit(m)})" for m in cfg.metrics) + ") v(metric)")
    add("grid_groups", "SELECT * FROM (VALUES " + ", ".join(f"({lit(g)})" for g in cfg.staff_groups)
        + ") v(staff_group)")
    add("grid_systems", "SELECT * FROM (VALUES " + ", ".join(f"({lit(s)})" for s in cfg.systems) + ") v(system)")
    f0, f1 = cfg.grid_first_period, cfg.grid_last_period
    add("grid_periods", f"SELECT {period('d')} AS period FROM (SELECT unnest(generate_series(DATE "
        f"'{f0 // 100}-{f0 % 100:02d}-01', DATE '{f1 // 100}-{f1 % 100:02d}-01', INTERVAL 1 MONTH)) AS d)")
    add("grid", "SELECT * FROM grid_metrics, grid_groups, grid_systems, grid_periods")
    total = f"staff_type = {lit(C.TOTAL_TYPE)}"
    slices = [
        _slice("s1", M[0], ALL, f"SELECT yearmonth, provider, value FROM t1 WHERE summary_detail = "
               f"{lit(C.SUBSTANTIVE_WTE)}"),
        _slice("s2", M[1], ALL, f"SELECT yearmonth, provider, {strict_sum('value')} AS value FROM t13 "
               f"WHERE bank_agency = {lit(C.BANK)} AND {total} GROUP BY yearmonth, provider"),
        _slice("s3", M[2], ALL, f"SELECT yearmonth, provider, {strict_sum('value')} AS value FROM t13 "
               f"WHERE bank_agency = {lit(C.AGENCY)} AND {total} GROUP BY yearmonth, provider"),
        _slice("s4", M[3], ALL, f"SELECT yearmonth, provider, value FROM t6 WHERE staff_group = {lit(C.ALL_ROLES)} "
               f"AND {total}"),
        _slice("s5", M[4], ALL, f"SELECT yearmonth, provider, rate AS value FROM vacancies WHERE type = "
               f"{lit(C.MAIN_VACANCY)}"),
        _slice("s6", M[5], ALL, f"SELECT yearmonth, provider, value FROM variance WHERE reference_sheet = "
               f"{lit(C.SICKNESS_SHEET)} AND metric = 'Actual'"),
        _slice("s7", M[6], ALL, f"SELECT yearmonth, provider, value FROM variance WHERE reference_sheet = "
               f"{lit(C.TURNOVER_SHEET)} AND metric = 'Actual'"),
        _slice("s8", M[7], ALL, f"SELECT yearmonth, provider, value FROM t1 WHERE summary_detail = "
               f"{lit(C.ALL_STAFF_WTE)}"),
        _slice("s9", M[0], NOT_ALL, f"SELECT provider, yearmonth, staff_group, {strict_sum('value')} AS value FROM t2 "
               f"WHERE {total} AND NOT coalesce(staff_group IN {in_list(C.EXCLUDED_SUBSTANTIVE_GROUPS)}, false) "
               "GROUP BY provider, yearmonth, staff_group", keys3=True),
        _slice("s10", M[1], NOT_ALL, f"SELECT yearmonth, provider, value, staff_group FROM t13 WHERE bank_agency = "
               f"{lit(C.BANK)} AND {total}", keys3=True),
        _slice("s11", M[2], NOT_ALL, f"SELECT yearmonth, provider, value, staff_group FROM t13 WHERE bank_agency = "
               f"{lit(C.AGENCY)} AND {total}", keys3=True),
        _slice("s12", M[3], NOT_ALL, f"SELECT yearmonth, provider, value, staff_group FROM t6 WHERE {total} AND "
               f"NOT coalesce(staff_group IN {in_list(C.EXCLUDED_VACANCY_GROUPS)}, false)", keys3=True),
    ]
    for s in slices:
        name, body = s.split(" AS (", 1)
        add(name, body[:-1])
    add("overview_raw", " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(1, 13)))
    add("sums_ics", f"SELECT period, staff_group, metric, CASE WHEN metric IN {in_list(cfg.rate_metrics)} THEN NULL "
        f"ELSE {sum_na_rm('value')} END AS sum_value FROM overview_raw WHERE system <> {lit(ICS)} "
        "GROUP BY period, staff_group, metric")
    add("overview_final", f"SELECT o.metric, o.staff_group, o.system, o.period, CASE WHEN o.system = {lit(ICS)} "
        "THEN s.sum_value ELSE o.value END AS value, make_date(o.period // 100, o.period % 100, 1) AS date "
        "FROM overview_raw o LEFT JOIN sums_ics s ON o.period = s.period AND o.staff_group = s.staff_group "
        f"AND o.metric = s.metric WHERE o.period <= {L}")
    # messy numbers and line ratios
    add("messy", "SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'n/a' WHEN 'signup' THEN NULL "
        "WHEN 'view' THEN ' ' || d || ' ' WHEN 'click' THEN d || 'd' ELSE (CASE WHEN value < 10 THEN '0x' || d "
        "WHEN value < 20 THEN '-Infinity' WHEN value < 30 THEN '1,' || d WHEN value < 40 THEN 'NaN' "
        "ELSE d || 'e1' END) END AS raw "
        "FROM (SELECT event_id, event_type, value, regexp_extract(props, '[0-9]+', 0) AS d FROM events)")
    add("line_ratios", "SELECT l_orderkey, l_linenumber, l_tax + l_discount AS total, l_tax - l_discount AS difference, "
        f"{div('l_tax', 'l_discount')} AS ratio FROM lineitem")
    planted = (f"(provider = 'AMERICA' AND yearmonth = 199712 AND type = {lit(C.BANK_PLAN)}) "
               "OR (provider = 'ASIA' AND type = 'Other Plan')")
    add("planted", f"SELECT yearmonth, provider, type, CASE WHEN {planted} THEN NULL ELSE plan END AS plan FROM planned")
    return t


def with_ctes(select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in _ctes()) + "\n" + select


_ALL_STAFF_SLICES = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(1, 9))
_GROUP_SLICES = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(9, 13))
_KPI_PAIR = in_list([C.TURNOVER_KPI, C.SICKNESS_KPI])
_HCSW = in_list(C.HCSW_RATE_MEASURES)

#: published table, its relation and its leading measure
_PUBLISHED = [
    *((name, f"t{i}", "value") for i, name in enumerate(C.PUBLISHED_LOOKUP_TABLES, start=1) if name not in ("KPI", "HCSW")),
    ("KPI", f"(SELECT * FROM kpi_all WHERE yearmonth <= {L})", "value"),
    ("HCSW", f"(SELECT * FROM t12 WHERE NOT coalesce(measure_detail IN {_HCSW}, false))", "value"),
    ("HCSW_Vacancy_Rate", f"(SELECT * FROM t12 WHERE measure_detail IN {_HCSW} AND yearmonth <= {L})", "value"),
    ("Vacancy_Rate_Calc", "vacancies", "total"), ("Staffing_Actual_Plan", "staffing_all", "plan"),
    ("Sickness_Turnover", "variance", "value"), ("Main_Overview", "overview_final", "value"),
]

SELECTS: dict[str, str] = {
    "src_dir_scan": "SELECT * FROM wide",
    "src_provider_from_filename": f"SELECT DISTINCT submission AS file_name, "
                                  f"{PROVIDER_FROM_NAME.format('submission')} AS provider FROM wide",
    "src_sheet_range": "SELECT * FROM wide WHERE sheet_no BETWEEN 3 AND 9",
    "src_named_sheet": "SELECT maincode, reference_sheet, staff_group, staff_type FROM ref_long WHERE sheet = 6",
    "src_csv_roundtrip": f"SELECT *, DATE '{LOAD}' AS load_date FROM fact",
    "src_historic_query": "SELECT * FROM fact WHERE yearmonth < 199704",
    "stream_inbox_ingest": "SELECT * FROM ingest",
    "inbox_resubmitted": "SELECT maincode, yearmonth, CASE WHEN provider = 'ASIA' AND yearmonth % 100 = 4 THEN '7' ELSE value END "
                         "AS value, provider, load_date FROM ingest",
    "inbox_csv_banner": "SELECT * FROM ingest",
    "monthly_tables_profile": " UNION ALL ".join(
        f"SELECT {lit(name)} AS table_name, count(*) AS n_rows, round(sum(CASE WHEN isfinite({value}) THEN {value} END), 4) AS total "
        f"FROM {rel}" for name, rel, value in _PUBLISHED),
    "sink_replace_table": "SELECT * FROM t1",
    "proj_load_date": f"SELECT *, DATE '{LOAD}' AS load_date FROM fact",
    "proj_positional": "SELECT " + ", ".join(f'"{m}"' for m in MONTHS) + ', "Maincode" FROM wide',
    "proj_named": "SELECT provider, yearmonth, value, summary_detail FROM t1",
    "proj_drop": "SELECT * FROM fact",
    "proj_rename": "SELECT maincode, yearmonth AS period, value AS vacancy, provider, reference_sheet, staff_group, "
                   "staff_type FROM t6",
    "proj_constant": "SELECT *, 'Vacancy' AS type, 'submission' AS source FROM t6",
    "filter_valid_codes": f'SELECT submission, sheet_no, "Maincode" FROM wide WHERE "Maincode" IS NOT NULL '
                          f'AND "Maincode" NOT IN {in_list(C.HEADER_WORDS)}',
    "filter_conjunction": f"SELECT * FROM t2 WHERE staff_group = {lit(C.NURSING_GROUP)} AND staff_type = 'Total'",
    "filter_in": f"SELECT * FROM t12 WHERE measure_detail IN {_HCSW}",
    "filter_not_in_keep_null": "SELECT * FROM kpi_kept",
    "filter_not_equal": f"SELECT * FROM t13 WHERE staff_group <> {lit(C.ALL_STAFF_GROUP)}",
    "filter_cutoff": f"SELECT * FROM fact WHERE yearmonth <= {L}",
    "filter_split": f"SELECT *, 'rate' AS part FROM t12 WHERE measure_detail IN {_HCSW} AND yearmonth <= {L} "
                    f"UNION ALL SELECT *, 'rest' FROM t12 WHERE NOT coalesce(measure_detail IN {_HCSW}, false)",
    "reshape_months_long": "SELECT * FROM wide_long",
    "reshape_providers_long": " UNION ALL ".join(
        f"SELECT date, {lit(r)} AS provider, CAST(\"{r}\" AS DOUBLE) AS value FROM sickness_wide" for r in S.REGIONS),
    "reshape_measures_long": "SELECT * FROM variance_all",
    "join_code_lookup": "SELECT * FROM joined",
    "join_inner_two_keys": "SELECT v.yearmonth, v.vacancy, v.provider, s.substantive FROM vac_main v JOIN sub_main s "
                           f"ON {nsafe('v', 's', ['provider', 'yearmonth'])}",
    "join_fan_out": "SELECT v.provider, v.yearmonth, v.n AS left_rows, s.n AS right_rows, v.n * s.n AS rows FROM "
                    "(SELECT provider, yearmonth, count(*) AS n FROM vac_main GROUP BY ALL) v JOIN "
                    "(SELECT provider, yearmonth, count(*) AS n FROM sub_main GROUP BY ALL) s "
                    f"ON {nsafe('v', 's', ['provider', 'yearmonth'])}",
    "join_full_outer": "SELECT coalesce(a.yearmonth, p.yearmonth) AS yearmonth, a.substantive, "
                       "coalesce(a.provider, p.provider) AS provider, p.plan FROM wte_agency a FULL JOIN agency_plan p "
                       f"ON {nsafe('a', 'p', ['provider', 'yearmonth'])}",
    "join_left_renamed_key": "SELECT * FROM st_joined",
    "overview_all_staff": f"SELECT * FROM ({_ALL_STAFF_SLICES}) WHERE period <= {L}",
    "overview_staff_groups": f"SELECT * FROM ({_GROUP_SLICES}) WHERE period <= {L}",
    "overview_ics_rollup": f"SELECT * FROM overview_final WHERE system = {lit(ICS)}",
    "grid_cross_product": "SELECT metric, staff_group, system, period FROM grid_metrics, grid_groups, "
                          f"(SELECT r_name AS system FROM region UNION ALL SELECT {lit(ICS)}), grid_periods",
    "join_collision_names": "SELECT g.metric, g.staff_group, g.system, g.period, x.value FROM (SELECT * FROM grid "
                            f"WHERE metric = 'Vacancies' AND {ALL}) g LEFT JOIN (SELECT * FROM t6 WHERE staff_group = "
                            f"{lit(C.ALL_ROLES)} AND staff_type = 'Total') x ON g.system = x.provider "
                            "AND g.period = x.yearmonth",
    "agg_strict_sum": f"SELECT provider, type, {strict_sum('plan')} AS plan FROM planted GROUP BY provider, type",
    "agg_sum_na_rm": f"SELECT provider, type, {sum_na_rm('plan')} AS plan FROM planted GROUP BY provider, type",
    "agg_system_total": f"SELECT * FROM wte_sub UNION ALL {_sys('wte_sub', 'substantive')}",
    "agg_distinct_profile": "SELECT DISTINCT sheet, reference_sheet FROM looked",
    "agg_row_count": "SELECT count(*) AS rows, 'main' AS frame FROM t1 UNION ALL "
                     "SELECT (SELECT count(*) FROM t1) + (SELECT count(*) FROM t6), 'result'",
    "union_strict": "SELECT * FROM kpi_all",
    "union_fill_missing": f"{_pva('main_vacancy', 'main_plan')} UNION ALL SELECT yearmonth, provider, substantive, "
                          "plan, difference_wte, percentage_difference, CAST(NULL AS DOUBLE) FROM "
                          f"({_avp('wte_agency', 'agency_plan')})",
    "union_contracted": "SELECT maincode, yearmonth, value, provider, reference_sheet, summary_detail, "
                        f"CAST(NULL AS VARCHAR) AS staff_group, CAST(NULL AS VARCHAR) AS staff_type, DATE '{LOAD}' "
                        "AS load_date FROM t1 UNION ALL SELECT maincode, yearmonth, value, provider, reference_sheet, "
                        f"CAST(NULL AS VARCHAR), staff_group, staff_type, DATE '{LOAD}' FROM t6",
    "scalar_numeric_coerce": f"SELECT event_id, event_type, raw, {to_number('raw')} AS value FROM messy",
    "scalar_abs": "SELECT maincode, yearmonth, provider, abs(value) AS value FROM looked WHERE sheet = 6",
    "scalar_ratio_ieee": "SELECT * FROM line_ratios",
    "scalar_nan_to_null": _nan_cols("line_ratios", ["l_orderkey", "l_linenumber", "total", "difference", "ratio"],
                                    {"total", "difference", "ratio"}),
    "scalar_case_when": f"SELECT maincode, yearmonth, provider, workforce_kpi, CASE WHEN workforce_kpi = "
                        f"{lit(C.TURNOVER_KPI)} THEN {lit(C.TURNOVER_TYPE)} WHEN workforce_kpi = {lit(C.SICKNESS_KPI)} "
                        f"THEN {lit(C.SICKNESS_TYPE)} END AS type FROM (SELECT * FROM t5 UNION ALL SELECT * FROM st_long)",
    "scalar_date_to_period": f"SELECT o_orderkey, {period('o_orderdate')} AS period FROM orders",
    "scalar_period_to_date": "SELECT DISTINCT yearmonth, make_date(yearmonth // 100, yearmonth % 100, 1) AS date "
                             "FROM fact",
    "scalar_month_sequence": "SELECT provider, CAST(unnest(generate_series(date_trunc('month', first), "
                             "date_trunc('month', last), INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT "
                             "cp.provider, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders JOIN "
                             "cust_prov cp ON o_custkey = cp.c_custkey GROUP BY cp.provider)",
    "scalar_period_cast": "SELECT * FROM planned",
    "ingest_wide_submissions": "SELECT * FROM ingest",
    "fact_union_historic": "SELECT * FROM fact",
    "lookup_all_sheets": "SELECT * FROM looked",
    "lookup_bank_agency": "SELECT * FROM t13",
    "measure_vacancy_rate": "SELECT * FROM main_vacancy",
    "measure_vacancy_rate_group": "SELECT * FROM nursing_vacancy",
    "measure_vacancy_rate_system": "SELECT * FROM main_vacancy_sys UNION ALL SELECT * FROM nursing_vacancy_sys",
    "measure_vacancies_combined": "SELECT * FROM vacancies",
    "plan_by_type": "SELECT * FROM main_plan",
    "plan_system_total": "SELECT * FROM main_plan_sys",
    "measure_plan_vs_actual": _pva("main_vacancy", "main_plan"),
    "wte_by_type": "SELECT * FROM wte_agency UNION ALL SELECT * FROM wte_agency_sys",
    "measure_actual_vs_plan": _avp("wte_agency", "agency_plan"),
    "measure_staffing_plan_all": "SELECT * FROM staffing_all",
    "kpi_override": f"SELECT * FROM kpi_all WHERE yearmonth <= {L}",
    "measure_variance_long": "SELECT * FROM variance",
    "main_overview": "SELECT * FROM overview_final",
    "monthly_run_published": "SELECT * FROM overview_final",
}


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in SELECTS.items()}
