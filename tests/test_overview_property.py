"""The overview redesign (one grid join + grouped roll-up) against a brute-force
statement of the step-by-step semantics (twelve slice left joins, roll-up
re-join) on random inputs with NULL keys and labels, duplicates and fan-out."""

import datetime as dt
import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from staffline import config as C
from staffline.config import RunConfig
from staffline.plans import overview

GROUPS = (C.ALL_STAFF_GROUP, "Clinical Support", "Medical and dental")
CFG = RunConfig(providers=("P1", "P2"), staff_groups=GROUPS, grid_first_period=202404, grid_last_period=202406,
                latest_month=202405)
PERIODS = (202404, 202405, 202406)
PROVIDERS = ("P1", "P2", "ICS", "X", None)
VALUES = st.one_of(st.none(), st.integers(-3, 9).map(float))
KEYS = st.tuples(st.sampled_from(PERIODS), st.sampled_from(PROVIDERS))


def rows_of(*label_sets, n=8):
    return st.lists(st.tuples(KEYS, VALUES, *[st.sampled_from(s) for s in label_sets]), max_size=n)


INPUTS = st.fixed_dictionaries({
    "overall": rows_of((C.SUBSTANTIVE_WTE, C.ALL_STAFF_WTE, "Other", None)),
    "staff": rows_of(GROUPS + ("Obs & Gynae", None), ("Total", "Reg", None)),
    "ba": rows_of((C.BANK, C.AGENCY, None), GROUPS + (None,), ("Total", "Reg")),
    "vacancy": rows_of(GROUPS + (C.ALL_ROLES, "CC/ICU Nursing", None), ("Total", "Reg", None)),
    "vacancies": rows_of((C.MAIN_VACANCY, C.NURSING_VACANCY)),
    "variance": rows_of((C.SICKNESS_SHEET, C.TURNOVER_SHEET), ("Actual", "Plan")),
})


def strict(vals):
    return None if any(v is None for v in vals) else float(sum(vals))


def brute_force(i):
    """Twelve slice left joins of the grid, bound together, then the roll-up."""
    M = C.METRICS
    grid = [(m, g, s, p) for m in CFG.metrics for g in GROUPS for s in CFG.systems for p in PERIODS]

    def slice_(metric, all_staff, source, keys3=False):
        out = []
        for m, g, s, p in grid:
            if m != metric or (g == C.ALL_STAFF_GROUP) != all_staff:
                continue
            hits = [v for (pp, ss, gg, v) in source if pp == p and ss == s and (not keys3 or gg == g)]
            out += [(m, g, s, p, v) for v in hits] or [(m, g, s, p, None)]
        return out

    def summed(rows, key):
        groups = {}
        for r in rows:
            groups.setdefault(key(r), []).append(r[1])
        return groups

    ov = i["overall"]
    src1 = [(p, s, None, v) for (p, s), v, d in ov if d == C.SUBSTANTIVE_WTE]
    src8 = [(p, s, None, v) for (p, s), v, d in ov if d == C.ALL_STAFF_WTE]
    ba_total = [r for r in i["ba"] if r[4] == "Total"]
    def usage(kind):
        g = summed([r for r in ba_total if r[2] == kind], lambda r: r[0])
        return [(p, s, None, strict(v)) for (p, s), v in g.items()]
    src4 = [(p, s, None, v) for (p, s), v, g, t in i["vacancy"] if g == C.ALL_ROLES and t == "Total"]
    src5 = [(p, s, None, v) for (p, s), v, t in i["vacancies"] if t == C.MAIN_VACANCY]
    def rate(sheet):
        return [(p, s, None, v) for (p, s), v, sh, m in i["variance"] if sh == sheet and m == "Actual"]
    staff = [r for r in i["staff"] if r[3] == "Total" and r[2] != "Obs & Gynae"]
    g9 = summed(staff, lambda r: (r[0], r[2]))
    src9 = [(p, s, g, strict(v)) for ((p, s), g), v in g9.items()]
    def usage_groups(kind):
        return [(p, s, g, v) for (p, s), v, k, g, t in ba_total if k == kind]
    src12 = [(p, s, g, v) for (p, s), v, g, t in i["vacancy"]
             if t == "Total" and g not in C.EXCLUDED_VACANCY_GROUPS]
    raw = (slice_(M[0], True, src1) + slice_(M[1], True, usage(C.BANK)) + slice_(M[2], True, usage(C.AGENCY))
           + slice_(M[3], True, src4) + slice_(M[4], True, src5) + slice_(M[5], True, rate(C.SICKNESS_SHEET))
           + slice_(M[6], True, rate(C.TURNOVER_SHEET)) + slice_(M[7], True, src8)
           + slice_(M[0], False, src9, True) + slice_(M[1], False, usage_groups(C.BANK), True)
           + slice_(M[2], False, usage_groups(C.AGENCY), True) + slice_(M[3], False, src12, True))
    sums = {}
    for m, g, s, p, v in raw:
        if s != "ICS":
            sums.setdefault((p, g, m), 0.0)
            sums[(p, g, m)] += v if v is not None else 0.0
    out = []
    for m, g, s, p, v in raw:
        if p > CFG.latest_month:
            continue
        if s == "ICS":
            v = None if m in CFG.rate_metrics else sums.get((p, g, m))
        out.append((m, g, s, p, v, dt.date(p // 100, p % 100, 1)))
    return sorted(out, key=repr)


def frames(spark, i):
    def df(rows, schema, flat):
        return spark.createDataFrame([flat(r) for r in rows], schema)
    base = "yearmonth int, provider string, value double"
    return dict(
        overall=df(i["overall"], base + ", summary_detail string", lambda r: (*r[0], r[1], r[2])),
        staff=df(i["staff"], base + ", staff_group string, staff_type string", lambda r: (*r[0], r[1], r[2], r[3])),
        ba=df(i["ba"], base + ", bank_agency string, staff_group string, staff_type string",
              lambda r: (*r[0], r[1], r[2], r[3], r[4])),
        vacancy=df(i["vacancy"], base + ", staff_group string, staff_type string",
                   lambda r: (*r[0], r[1], r[2], r[3])),
        vacancies=df(i["vacancies"], "yearmonth int, provider string, rate double, type string",
                     lambda r: (*r[0], r[1], r[2])),
        variance=df(i["variance"], base + ", reference_sheet string, metric string",
                    lambda r: (*r[0], r[1], r[2], r[3])),
    )


@settings(max_examples=12, deadline=None)
@given(INPUTS)
def test_overview_equals_slice_joins(spark, inputs):
    f = frames(spark, inputs)
    facts = overview.metric_facts(f["overall"], f["staff"], f["ba"], f["vacancy"], f["vacancies"], f["variance"])
    got = overview.main_overview(spark, facts, CFG).collect()
    got = sorted((tuple(r) for r in got), key=repr)
    assert got == brute_force(inputs)
    assert len({(m, g) for m, g, *_ in got}) == len(list(itertools.chain(overview.kept_pairs(CFG))))
