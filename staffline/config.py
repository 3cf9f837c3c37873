"""Run configuration and the fixed values the monthly run depends on.

Everything that was a global or a literal in the original scripts is an explicit
field here, so one code path serves the production labels and the test stand-ins.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These strings must equal the submission / code-list labels
# exactly (including the doubled spaces in the two KPI names), otherwise
# filters silently select nothing.
# ---------------------------------------------------------------------------

# Labels in the "Summary Staff WTE Detail" column of code-list sheet 1.
SUBSTANTIVE_WTE = "Total WTE Substantive Staff"
ALL_STAFF_WTE = "Total WTE all Staff"
AGENCY_WTE = "Agency Staff (including, agency and contract)"
BANK_WTE = "Bank Staff"

# Staff-group / staff-type labels used by the vacancy and overview slices.
ALL_ROLES = "All Roles"
NURSING_GROUP = "Nursing, midwifery and HV"
TOTAL_TYPE = "Total"
ALL_STAFF_GROUP = "All Staff"
EXCLUDED_SUBSTANTIVE_GROUPS = ("Obs & Gynae",)
EXCLUDED_VACANCY_GROUPS = ("All Roles", "Advanced Care", "CC/ICU Nursing")
BANK = "Bank"
AGENCY = "Agency"

# Vacancy measure types.
MAIN_VACANCY = "Main Vacancy"
NURSING_VACANCY = "Nursing, Midwifery and HV Vacancy"

# Plan types in the planned-staff sheet and the output type of each comparison.
SUBSTANTIVE_PLAN = "Substantive Plan"
NURSING_PLAN = "Nursing, Midwifery Plan"
AGENCY_PLAN = "Agency Plan"
BANK_PLAN = "Bank Plan"
STAFFING_VS_PLAN_SUBSTANTIVE = "Staffing Post Vs Plan Substantive"
STAFFING_VS_PLAN_NURSING = "Staffing Post Vs Plan Nursing & Midwifery"
AGENCY_ACTUAL_VS_PLAN = "Agency Actual Vs Plan"
BANK_ACTUAL_VS_PLAN = "Bank Actual Vs Plan"

# System-level member appended to provider-level measures.
SYSTEM_TOTAL_LABEL = "BSOL Total ICS"

# KPI series that are replaced by separately supplied monthly rates.
TURNOVER_KPI = "All Staff Turnover  - 12 month rolling rate %"
SICKNESS_KPI = "Sickness Absence Rate  - 12 month rolling %"
TURNOVER_CODE = "KPI0100"
SICKNESS_CODE = "KPI0140"
TURNOVER_SHEET = "Staff Turnover Rate"
SICKNESS_SHEET = "Staff Sickness Rate"
TURNOVER_TYPE = "Turnover Rate"
SICKNESS_TYPE = "Sickness Rate"

# Support-worker vacancy-rate measures split out of code-list sheet 12.
HCSW_RATE_MEASURES = (
    "Health Care Support Worker reported Vacancy rate",
    "Maternity Support Worker reported Vacancy rate",
)

# Dashboard grid dimensions.
METRICS = (
    "Substantive Staff In Post",
    "Bank Usage",
    "Agency Usage",
    "Vacancies",
    "Vacancy Rate",
    "Sickness Rate",
    "Turnover Rate",
    "Total Staff In Post",
)
STAFF_GROUPS = (
    "All Staff",
    "Ambulance Service Staff",
    "Any Other Staff",
    "Clinical Support",
    "Medical and dental",
    "NHS infrastructure support",
    "Nursing, midwifery and HV",
    "Scientific, therapeutic and technical",
)
GRID_TOTAL_SYSTEM = "ICS"
PROVIDERS = ("UHB", "BWCH", "ROH", "BCHC", "BSMHFT")
RATE_METRICS = ("Vacancy Rate", "Sickness Rate", "Turnover Rate")

# Names the 13 looked-up tables are published under, in code-list sheet order
# (index 13 is bank + agency).
PUBLISHED_LOOKUP_TABLES = (
    "Overall", "Staff_Group", "Bank_Staff", "Agency_Staff", "KPI", "Vacancy",
    "IR", "AHP_IR", "Maternity", "PNA", "PMA", "HCSW", "Bank_Agency",
)
PUBLISHED_MEASURE_TABLES = (
    "Vacancy_Rate_Calc", "Staffing_Actual_Plan", "HCSW_Vacancy_Rate",
    "Sickness_Turnover", "Main_Overview",
)

# Code-list sheet numbers.
SHEET_OVERALL = 1
SHEET_STAFF_GROUP = 2
SHEET_BANK = 3
SHEET_AGENCY = 4
SHEET_KPI = 5
SHEET_VACANCY = 6
SHEET_HCSW = 12

# Columns each code-list sheet carries besides ``maincode`` (snake_case names of
# the workbook headers). Unknown extra columns pass through untouched.
SHEET_COLUMNS = {
    1: ("reference_sheet", "summary_detail"),
    2: ("reference_sheet", "staff_group", "staff_type"),
    3: ("reference_sheet", "bank_agency", "staff_group", "staff_type"),
    4: ("reference_sheet", "bank_agency", "staff_group", "staff_type"),
    5: ("workforce_kpi", "reference_sheet"),
    6: ("reference_sheet", "staff_group", "staff_type"),
    7: ("reference_sheet",),
    8: ("reference_sheet",),
    9: ("reference_sheet",),
    10: ("reference_sheet",),
    11: ("reference_sheet",),
    12: ("reference_sheet", "measure_detail"),
}
REF_ATTRIBUTE_COLUMNS = (
    "reference_sheet", "summary_detail", "staff_group", "staff_type",
    "bank_agency", "workforce_kpi", "measure_detail",
)

# Positional contract of a wide submission sheet (1-based): months, code.
WIDE_MONTH_POSITIONS = tuple(range(6, 18))
WIDE_CODE_POSITION = 19
HEADER_WORDS = ("Subcode", "Maincode")
SUBMISSION_SHEETS = (3, 9)


def fiscal_year_labels(start_year: int) -> tuple[int, ...]:
    """The 12 ``yyyymm`` periods April..March of the fiscal year starting in ``start_year``."""
    return tuple(
        (start_year if m >= 4 else start_year + 1) * 100 + m
        for m in (4, 5, 6, 7, 8, 9, 10, 11, 12, 1, 2, 3)
    )


def labels_of_marker(marker: str) -> tuple[int, ...]:
    """The periods of a ``yy-yy`` marker's fiscal year; none when it is no such marker."""
    if len(marker) != 5 or marker[2] != "-" or not (marker[:2] + marker[3:]).isdigit():
        return ()
    yy = int(marker[:2])
    return fiscal_year_labels(yy + (1900 if yy >= 50 else 2000))


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one monthly run (all globals of the original scripts)."""

    latest_month: int = 202407
    fiscal_year_marker: str = "24-25"
    month_labels: tuple[int, ...] = fiscal_year_labels(2024)
    providers: tuple[str, ...] = PROVIDERS
    grid_total_system: str = GRID_TOTAL_SYSTEM
    system_total_label: str = SYSTEM_TOTAL_LABEL
    metrics: tuple[str, ...] = METRICS
    staff_groups: tuple[str, ...] = STAFF_GROUPS
    grid_first_period: int = 202104
    grid_last_period: int | None = None  # None: the latest month
    rate_metrics: tuple[str, ...] = RATE_METRICS
    load_date: str | None = None  # ISO date; None = current_date()
    extra: dict = field(default_factory=dict)

    @property
    def last_period(self) -> int:
        """End of the dashboard grid: the latest month, or an earlier configured end."""
        return self.latest_month if self.grid_last_period is None else min(self.grid_last_period, self.latest_month)

    @property
    def systems(self) -> tuple[str, ...]:
        return (self.grid_total_system, *self.providers)

    def with_(self, **kw) -> "RunConfig":
        return replace(self, **kw)
