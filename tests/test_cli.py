"""The command-line monthly run on inputs landed with their original headers."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from staffline import cli
from staffline import config as C

from test_fixture_run import FACT, HISTORIC, PLANNED, REF


@pytest.mark.parametrize("landing", ["parquet", "csv"])
def test_cli_run_on_landed_files(spark, landing):
    root = tempfile.mkdtemp(prefix="staffline-cli-")
    p = lambda n: os.path.join(root, n)
    # one wide workbook, months 202404..202503 by position, code at column 19
    heads = ["Org", "Year", "Sheet", "Group", "Desc", *[f"M{i}" for i in range(1, 13)], "YTD", "Maincode"]
    wide = [("x", "24-25", "s", "g", "d", "100", "101", *[None] * 10, "201", "S1", "UHB 24-25 M04", 3),
            ("x", "24-25", "s", "g", "d", "-10", None, *[None] * 10, "-10", "V1", "UHB 24-25 M04", 3)]
    schema = ", ".join(f"`{h}` string" for h in heads) + ", submission string, sheet_no int"
    if landing == "parquet":
        spark.createDataFrame(wide, schema).write.partitionBy("submission", "sheet_no").parquet(p("inbox"))
        how = ["--sheet-columns", ",".join(heads), "--archive", p("archive")]
    else:  # as exported: a banner line, the headers, the rows; followed by content instead of by path
        folder = os.path.join(p("inbox"), "submission=UHB 24-25 M04", "sheet_no=3")
        os.makedirs(folder)
        lines = ["Monthly workforce return", ",".join(heads), *(",".join("" if c is None else c for c in row[:-2]) for row in wide)]
        with open(os.path.join(folder, "sheet.csv"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        how = ["--inbox-format", "csv", "--overwrite-scope", "content"]
    ref_cols = ["sheet", "Maincode", "Reference Sheet", "Summary Staff WTE Detail", "Staff Group", "Staff Type",
                "Bank/Agency", "Workforce KPI", "Measure Detail"]
    ref = spark.createDataFrame(REF, ", ".join(f"`{c}` {'int' if c == 'sheet' else 'string'}" for c in ref_cols))
    ref.withColumn("Notes", F.lit("as landed")).write.partitionBy("sheet").parquet(p("codes"))
    spark.createDataFrame(HISTORIC, "Maincode string, Yearmonth int, Value string, Provider string") \
        .write.parquet(p("historic"))
    spark.createDataFrame([(str(y), pr, t, v) for y, pr, t, v in PLANNED],
                          "Yearmonth string, Provider string, Type string, Plan double").write.parquet(p("plan"))
    spark.createDataFrame([(dt.date(2024, 4, 1), "202404", "UHB", C.SICKNESS_SHEET, 0.04)],
                          "Date date, Yearmonth string, Provider string, Type string, Plan double") \
        .write.parquet(p("prates"))
    rates = ", ".join(f"{x} double" for x in C.PROVIDERS)
    for n in ("sick", "turn"):
        spark.createDataFrame([(dt.date(2024, 4, 1), 0.1, 0.2, 0.3, 0.4, 0.5)], f"Date date, {rates}") \
            .write.parquet(p(n))

    out = cli.main([
        "--inbox", p("inbox"), *how, "--fact-out", p("fact"), "--code-list", p("codes"),
        "--planned-staff", p("plan"), "--planned-rates", p("prates"), "--sickness", p("sick"),
        "--turnover", p("turn"), "--historic", p("historic"), "--publish", p("published"),
        "--fiscal-year-start", "2024", "--load-date", "2024-08-05"])
    assert set(out) == set(C.PUBLISHED_LOOKUP_TABLES) | set(C.PUBLISHED_MEASURE_TABLES)
    overall = out["Overall"]
    assert "Notes" in overall.columns                       # unknown code-list column passed through
    got = sorted((r.yearmonth, r.value) for r in overall.filter(F.col("provider") == "UHB").collect())
    # blank month cells survive the unpivot and become 0 at lookup; 202408+ are cut off
    assert got == [(202403, 90.0), (202404, 100.0), (202405, 101.0), (202406, 0.0), (202407, 0.0)]
    vac = out["Vacancy_Rate_Calc"].filter((F.col("provider") == "UHB") & (F.col("type") == C.MAIN_VACANCY))
    assert sorted((r.yearmonth, r.vacancy, r.substantive, r.rate) for r in vac.collect()) == [
        (202404, 10.0, 100.0, 10.0 / 110.0), (202405, 0.0, 101.0, 0.0),
        (202406, 0.0, 0.0, None), (202407, 0.0, 0.0, None)]           # 0/0 -> NULL
    assert out["Main_Overview"].count() > 0
