"""Ingest by content, CSV sheets with a banner line, numeric cells, trimmed codes, lost months."""

import os

import pytest
from pyspark.sql import functions as F

from staffline import cli
from staffline import config as C
from staffline.sources import landing
from staffline.streaming import inbox, resubmission

from conftest import rows

HEADERS = ("Org", "Year", "Sheet", "Group", "Desc", *[f"m{i}" for i in range(1, 13)], "YTD", "Maincode")
LABELS = C.fiscal_year_labels(2024)
SETTINGS = dict(marker="24-25", month_labels=LABELS, load_date="2024-08-05")


def sheet(spark, book, number, cells, code_type="string"):
    """One sheet; ``cells``: code -> first month."""
    data = [("o", "24-25", f"s{number}", "g", "d", v, *["1"] * 11, "13", code, book, number) for code, v in cells.items()]
    return spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in HEADERS) + ", submission string, sheet_no int")


def land(spark, src, book, sheets):
    """Write a workbook under its name, replacing the sheets it holds."""
    for number, cells in sheets.items():
        (sheet(spark, book, number, cells).drop("submission", "sheet_no").coalesce(1).write.mode("overwrite")
         .parquet(f"{src}/submission={book}/sheet_no={number}"))


def ingest(spark, src, out):
    return resubmission.ingest_by_content(spark, inbox.read_inbox(spark, src, HEADERS), out, 202404, **SETTINGS)


def fact(spark, out):
    return rows(resubmission.read_fact_by_content(spark, out).select("provider", "maincode", "value"))


def test_three_runs_follow_the_content(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "fact")
    land(spark, src, "UHB 24-25 M04", {3: {"A": "1", "B": "2"}, 4: {"C": "3"}})
    land(spark, src, "ROH 24-25 M04", {3: {"A": "9"}})
    assert resubmission.read_fact_by_content(spark, out).count() == 0
    assert ingest(spark, src, out) == ["ROH 24-25 M04", "UHB 24-25 M04"]
    assert fact(spark, out) == [("ROH", "A", "9"), ("UHB", "A", "1"), ("UHB", "B", "2"), ("UHB", "C", "3")]
    # resent under the old name: one value changed, one code gone, one sheet empty of valid codes; the other equal
    land(spark, src, "UHB 24-25 M04", {3: {"A": "5"}, 4: {"Maincode": "x"}})
    land(spark, src, "ROH 24-25 M04", {3: {"A": "9"}})
    assert ingest(spark, src, out) == ["UHB 24-25 M04"]
    assert fact(spark, out) == [("ROH", "A", "9"), ("UHB", "A", "5")]
    # nothing changed
    ledger = len(os.listdir(f"{out}/{resubmission.LEDGER}"))
    assert ingest(spark, src, out) == [] and len(os.listdir(f"{out}/{resubmission.LEDGER}")) == ledger
    # back to the content of the first run
    land(spark, src, "UHB 24-25 M04", {3: {"A": "1", "B": "2"}, 4: {"C": "3"}})
    assert ingest(spark, src, out) == ["UHB 24-25 M04"]
    assert fact(spark, out) == [("ROH", "A", "9"), ("UHB", "A", "1"), ("UHB", "B", "2"), ("UHB", "C", "3")]


def test_a_run_that_fails_before_the_ledger_changes_nothing(spark, tmp_path, monkeypatch):
    src, out = str(tmp_path / "in"), str(tmp_path / "fact")
    land(spark, src, "UHB 24-25 M04", {3: {"A": "1"}})
    ingest(spark, src, out)
    land(spark, src, "UHB 24-25 M04", {3: {"A": "2"}})
    with monkeypatch.context() as m:
        m.setattr(resubmission, "LEDGER", "_ledger/no\0name")  # the ledger cannot be written
        m.setattr(resubmission, "current_versions", lambda *_: spark.createDataFrame([], "workbook string, version string"))
        with pytest.raises(Exception):  # noqa: B017
            ingest(spark, src, out)
    assert fact(spark, out) == [("UHB", "A", "1")]
    assert ingest(spark, src, out) == ["UHB 24-25 M04"]
    assert fact(spark, out) == [("UHB", "A", "2")]


def test_a_workbook_without_rows_replaces_its_version(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "fact")
    land(spark, src, "UHB 24-25 M04", {3: {"A": "1"}})
    ingest(spark, src, out)
    land(spark, src, "UHB 24-25 M04", {3: {"Subcode": "1"}})
    assert ingest(spark, src, out) == ["UHB 24-25 M04"]
    assert fact(spark, out) == []


def test_fingerprints_tell_content_not_layout(spark):
    one = sheet(spark, "B", 3, {"A": "1", "C": None, "D": ""})
    def print_of(df):
        return df.transform(resubmission.fingerprints).first()["version"]
    assert print_of(one) == print_of(one.repartition(7)) == print_of(one.orderBy(F.desc("Maincode")))
    assert print_of(one) != print_of(sheet(spark, "B", 4, {"A": "1", "C": None, "D": ""}))
    assert print_of(one) != print_of(sheet(spark, "B", 3, {"A": "1", "C": "", "D": None}))
    assert print_of(one) != print_of(one.unionByName(one))


def csv_book(src, book, number, lines, banner="Monthly return of the trust,,printed"):
    folder = src / f"submission={book}" / f"sheet_no={number}"
    folder.mkdir(parents=True)
    head = [banner] if banner is not None else []
    (folder / "sheet.csv").write_text("\n".join([*head, ",".join(HEADERS), *lines]) + "\n")


def test_csv_sheets_with_a_banner(spark, tmp_path):
    src = tmp_path / "in"
    line = 'o,24-25,s,g,"d, quoted",{},1,,3,4,5,,,,,,,13,{}'
    csv_book(src, "UHB 24-25 M04", 3, [line.format(12, " S1 "), line.format("n/a", "S2"), line.format(1, ""), line.format(1, "Maincode")])
    csv_book(src, "ROH 24-25 M04", 4, [line.format("1.5", "S3")])
    columns = inbox.landed_columns(spark, str(src), "csv")
    assert [c for c in columns.names if c not in inbox.LANDING_KEYS] == list(HEADERS)
    wide = inbox.read_inbox(spark, str(src), columns, "csv")
    assert wide.count() == 5
    got = rows(inbox.submissions_long(wide, 202404, **SETTINGS).select("provider", "maincode", "value"))
    assert got == [("ROH", "S3", "1.5"), ("UHB", "S1", "12"), ("UHB", "S2", "n/a")]


def test_csv_scan_is_splittable(spark, tmp_path):
    """Small splits read the same rows: only the split at position 0 of a file holds the head lines."""
    src = tmp_path / "in"
    csv_book(src, "UHB 24-25 M04", 3, [f"o,24-25,s,g,d,{i},1,,3,4,5,,,,,,,13,C{i}" for i in range(2000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        wide = inbox.read_inbox(spark, str(src), HEADERS, "csv")
        assert wide.rdd.getNumPartitions() > 4
        assert wide.select("Maincode").distinct().count() == wide.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_without_a_banner(spark, tmp_path):
    src = tmp_path / "in"
    csv_book(src, "UHB 24-25 M04", 3, ["o,24-25,s,g,d,12,1,,3,4,5,,,,,,,13,S1"], banner=None)
    columns = inbox.landed_columns(spark, str(src), "csv", banner=False)
    assert inbox.read_inbox(spark, str(src), columns, "csv", banner=False).select("Maincode", "m1").collect() == [("S1", "12")]


def test_streaming_csv_inbox(spark, tmp_path):
    src = tmp_path / "in"
    csv_book(src, "UHB 24-25 M04", 3, ["o,24-25,s,g,d,12,1,,3,4,5,,,,,,,13,S1"])
    out = str(tmp_path / "fact")
    inbox.stream_inbox(spark, str(src), out, str(tmp_path / "ckpt"), inbox.landed_columns(spark, str(src), "csv"), 202404,
                       month_labels=LABELS, load_date="2024-08-05", fmt="csv")
    assert rows(inbox.read_fact(spark, out).select("provider", "maincode", "value")) == [("UHB", "S1", "12")]


def test_numeric_cells(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "fact")
    text = sheet(spark, "UHB 24-25 M04", 3, {"S1": "12.5", "S2": None})
    text.withColumn("m1", F.col("m1").cast("double")).write.partitionBy("submission", "sheet_no").parquet(src)
    columns = inbox.landed_columns(spark, src)
    assert dict((f.name, f.dataType.simpleString()) for f in columns.fields)["m1"] == "double"
    inbox.stream_inbox(spark, src, out, str(tmp_path / "ckpt"), columns, 202404, month_labels=LABELS, load_date="2024-08-05")
    assert rows(inbox.read_fact(spark, out).select("maincode", "value")) == [("S1", "12.5"), ("S2", None)]


def test_codes_and_labels_are_trimmed(spark):
    ref = spark.createDataFrame([("3", " S1\t", " Total ", " ", "kept as it is ")],
                                "sheet string, Maincode string, `Staff Type` string, `Staff Group` string, Notes string")
    got = landing.code_list(landing.normalise_headers(ref)).first()
    assert (got["sheet"], got["maincode"], got["staff_type"], got["staff_group"], got["Notes"]) == (3, "S1", "Total", None, "kept as it is ")


def test_lost_months_are_named(spark):
    schema = "maincode string, yearmonth int, value string, provider string"
    current = spark.createDataFrame([("A", 202404, "1", "P"), ("A", 202403, "1", "P"), ("A", 202303, "1", "P"), ("B", 202303, "1", "P")], schema)
    historic = spark.createDataFrame([("A", 202403, "1", "P")], schema)
    assert cli.lost_periods(current, historic, LABELS) == [(202303, 2)]
    assert cli.lost_periods(current, historic, None) == []
