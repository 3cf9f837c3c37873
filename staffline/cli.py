"""Command-line entry for the monthly run on landed inputs.

    python -m staffline.cli --inbox <dir> --code-list <dir> --planned-staff <path> \\
        --planned-rates <path> --sickness <path> --turnover <path> \\
        (--historic <path> | --historic-jdbc-url <url> --historic-table <name>) \\
        --fact-out <dir> --publish <dir> [--latest-month 202407] [--marker 24-25]

Steps: ingest every workbook in the inbox (incrementally, archiving processed
files when ``--archive`` is given), union with the historic fact, and publish
all 18 tables under ``--publish``. All paths should be on shared storage.
"""

from __future__ import annotations

import argparse
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import RunConfig, fiscal_year_labels, labels_of_marker
from .plans import monthly
from .session import get_session
from .sources import jdbc, landing
from .streaming import inbox, resubmission


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="staffline")
    p.add_argument("--inbox", required=True, help="landed workbooks: submission=<name>/sheet_no=<n>/")
    p.add_argument("--sheet-columns", default=None,
                   help="comma list of the 19 sheet headers (default: read from the files)")
    p.add_argument("--archive", default=None, help="move processed workbook files here")
    p.add_argument("--checkpoint", default=None, help="streaming checkpoint (default under --fact-out)")
    p.add_argument("--fact-out", required=True, help="long fact table, partitioned by fiscal_year/provider")
    p.add_argument("--code-list", required=True)
    p.add_argument("--planned-staff", required=True)
    p.add_argument("--planned-rates", required=True)
    p.add_argument("--sickness", required=True)
    p.add_argument("--turnover", required=True)
    p.add_argument("--historic", default=None)
    p.add_argument("--historic-jdbc-url", default=None)
    p.add_argument("--historic-table", default=None)
    p.add_argument("--historic-option", action="append", default=[], metavar="KEY=VALUE",
                   help="connection option of the historic table (driver, user, ...); repeatable")
    p.add_argument("--historic-partition-column", default=None, help="read the historic table in parallel slices")
    p.add_argument("--historic-lower", type=int, default=None)
    p.add_argument("--historic-upper", type=int, default=None)
    p.add_argument("--historic-partitions", type=int, default=None)
    p.add_argument("--inbox-format", default="parquet", choices=["parquet", "csv"],
                   help="csv: sheets with a banner line, then the headers")
    p.add_argument("--no-banner", action="store_true", help="CSV sheets start with their headers")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--publish", required=True)
    p.add_argument("--latest-month", type=int, default=RunConfig().latest_month)
    p.add_argument("--marker", default=RunConfig().fiscal_year_marker)
    p.add_argument("--fiscal-year-start", type=int, default=None,
                   help="label months of a one-year inbox by position (e.g. 2024 -> 202404..202503)")
    p.add_argument("--load-date", default=None)
    p.add_argument("--overwrite-scope", default="fiscal_year", choices=[*sorted(inbox.OVERWRITE_SCOPES), "content"],
                   help="what one run replaces in the fact: the whole fiscal year (default), its providers, or "
                        "(content) the workbooks whose content is new or has changed, also under their old names")
    return p.parse_args(argv)


def inbox_columns(spark, path: str, fmt: str = "parquet", banner: bool = True) -> list[str]:
    """The sheet headers of the landed workbooks; none when nothing is landed."""
    found = inbox.landed_columns(spark, path, fmt, banner)
    return [c for c in found.names if c not in inbox.LANDING_KEYS] if found is not None else []


def of_fiscal_year(fact: DataFrame, labels) -> DataFrame:
    """The run's own fiscal year; earlier years come from the historic table, once."""
    return fact.where(F.col("yearmonth").isin(list(labels))) if labels else fact


def lost_periods(fact: DataFrame, historic: DataFrame, labels) -> list[tuple[int, int]]:
    """(period, rows) of the fact that belong to another fiscal year and are missing from the historic table as well."""
    if not labels:
        return []
    other = fact.where(~F.col("yearmonth").isin(list(labels))).groupBy("yearmonth").agg(F.count(F.lit(1)).alias("n"))
    missing = other.join(historic.select("yearmonth").distinct(), "yearmonth", "left_anti")
    return sorted((r["yearmonth"], r["n"]) for r in missing.collect())  # one row per month


def main(argv=None) -> dict:
    a = parse(argv)
    spark = get_session()
    cfg = RunConfig(latest_month=a.latest_month, fiscal_year_marker=a.marker, load_date=a.load_date)
    labels = fiscal_year_labels(a.fiscal_year_start) if a.fiscal_year_start else None

    banner = not a.no_banner
    columns = a.sheet_columns.split(",") if a.sheet_columns else inbox.landed_columns(spark, a.inbox, a.inbox_format, banner)
    year = labels or labels_of_marker(a.marker)
    if a.overwrite_scope == "content":
        if columns:
            resubmission.ingest_by_content(
                spark, inbox.read_inbox(spark, a.inbox, columns, a.inbox_format, banner), a.fact_out, cfg.latest_month,
                marker=a.marker, month_labels=labels, load_date=a.load_date, fallback_labels=year)
        fact = resubmission.read_fact_by_content(spark, a.fact_out)
    else:
        if columns:  # an empty inbox is a no-op
            inbox.stream_inbox(spark, a.inbox, a.fact_out, a.checkpoint or f"{a.fact_out.rstrip('/')}/_checkpoint",
                               columns, cfg.latest_month, archive=a.archive, marker=a.marker, month_labels=labels,
                               load_date=a.load_date, scope=a.overwrite_scope, fallback_labels=year,
                               fmt=a.inbox_format, banner=banner)
        fact = inbox.read_fact(spark, a.fact_out)
    current = of_fiscal_year(fact, year)

    if a.historic_jdbc_url:
        historic = jdbc.read_historic(
            spark, a.historic_jdbc_url, a.historic_table, dict(x.split("=", 1) for x in a.historic_option),
            a.historic_partition_column, a.historic_lower, a.historic_upper, a.historic_partitions)
    elif a.historic:
        historic = landing.fact_table(landing.read_landed(spark, a.historic, a.format))
    else:
        historic = spark.createDataFrame([], "maincode string, yearmonth int, value string, provider string")

    lost = lost_periods(fact, historic, year)
    if lost:
        warnings.warn("the fact holds months of another fiscal year that the historic table lacks; they are not published: "
                      + ", ".join(f"{m} ({n} rows)" for m, n in lost), stacklevel=2)

    read = lambda p: landing.read_landed(spark, p, a.format)
    inputs = monthly.RunInputs(
        current=current, historic=historic.select(*jdbc.HISTORIC_COLUMNS),
        ref_long=landing.code_list(read(a.code_list)),
        planned_staff=landing.planned(read(a.planned_staff)),
        planned_rates=landing.planned(read(a.planned_rates)),
        sickness_wide=landing.rates_wide(read(a.sickness)),
        turnover_wide=landing.rates_wide(read(a.turnover)),
    )
    return monthly.run(spark, inputs, a.publish, cfg)


if __name__ == "__main__":
    main()
