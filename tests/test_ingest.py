"""Wide submissions -> long fact, batch and incremental (two runs over one inbox)."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from staffline import config as C
from staffline.sources import files
from staffline.streaming import inbox

from conftest import rows

HEADERS = ("Org", "Year", "Sheet", "Group", "Desc", *[f"m{i}" for i in range(1, 13)], "YTD", "Maincode")
LABELS = C.fiscal_year_labels(2024)


def _wide(spark, submission, sheet, codes):
    """One sheet: each code gets month 1 = '1', month 2 blank, month 5 = '5' (202408)."""
    data = []
    for code in codes:
        months = ["1", None, "3", "4", "5"] + [None] * 7
        data.append(("o", "24-25", f"s{sheet}", "g", "d", *months, "13", code, submission, sheet))
    schema = ", ".join(f"`{h}` string" for h in HEADERS) + ", submission string, sheet_no int"
    return spark.createDataFrame(data, schema)


def _land(df, inbox_dir):
    df.write.mode("append").partitionBy("submission", "sheet_no").parquet(inbox_dir)


def test_batch_ingest_positional_contract(spark):
    d = tempfile.mkdtemp(prefix="staffline-inbox-")
    _land(_wide(spark, "ROH 24-25 M04", 3, ["C1", None, "Subcode", "Maincode"]), d)
    _land(_wide(spark, "ROH 24-25 M04", 10, ["X9"]), d)             # outside sheets 3-9
    wide = inbox.read_inbox(spark, d, HEADERS)
    out = inbox.submissions_long(wide, 202407, "24-25", month_labels=LABELS, load_date="2024-08-05")
    got = rows(out.select("maincode", "yearmonth", "value", "provider"))
    # header words and blank codes dropped; blank month kept; 202408 cut off
    assert got == [("C1", 202404, "1", "ROH"), ("C1", 202405, None, "ROH"),
                   ("C1", 202406, "3", "ROH"), ("C1", 202407, "4", "ROH")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "sheet_no" in plan


def test_provider_from_landing_folder(spark):
    d = tempfile.mkdtemp(prefix="staffline-inbox-")
    _land(_wide(spark, "BWCH 24-25 M04", 3, ["C1"]), d)
    _land(_wide(spark, "NoMarker", 3, ["C1"]), d)
    df = files.scan_dir(spark, d, schema=inbox.wide_schema(HEADERS))
    named = files.with_file_columns(df, "24-25", folder_key="submission")
    assert rows(named.select("file_name", "provider").distinct()) == [
        ("BWCH 24-25 M04", "BWCH"), ("NoMarker", "NoMarker")]


@pytest.mark.parametrize("scope", ["fiscal_year", "provider"])
def test_streaming_ingest_two_runs(spark, scope):
    root = tempfile.mkdtemp(prefix="staffline-stream-")
    src, out, ckpt, arch = (os.path.join(root, n) for n in ("inbox", "fact", "ckpt", "archive"))
    _land(_wide(spark, "ROH 24-25 M04", 3, ["C1"]), src)
    kw = dict(column_names=HEADERS, latest_month=202407, archive=arch, marker="24-25",
              month_labels=LABELS, load_date="2024-08-05", scope=scope)
    inbox.stream_inbox(spark, src, out, ckpt, **kw)
    first = inbox.read_fact(spark, out)
    assert rows(first.select("provider").distinct()) == [("ROH",)]
    assert first.count() == 4

    _land(_wide(spark, "UHB 24-25 M04", 4, ["C2"]), src)
    inbox.stream_inbox(spark, src, out, ckpt, **kw)
    second = inbox.read_fact(spark, out)
    if scope == "fiscal_year":   # the second run's inbox held only UHB: it is the fiscal year's snapshot
        assert rows(second.groupBy("provider").count()) == [("UHB", 4)]
    else:                        # only UHB's slice was replaced
        assert rows(second.groupBy("provider").count()) == [("ROH", 4), ("UHB", 4)]
    # the first workbook's files were archived once a later batch committed
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".parquet")]
    assert archived, "processed files should be moved to the archive folder"
    left = [p for p, _, fs in os.walk(src) for f in fs if f.endswith(".parquet") and "ROH" in p]
    assert not left
    assert second.filter(F.col("load_date") == F.lit("2024-08-05").cast("date")).count() == second.count()


def test_provider_from_real_file_names(spark):
    d = tempfile.mkdtemp(prefix="staffline-names-")
    for name in ("ROH 24-25 M04.csv", "BWCH 24-25+draft.csv", "NoMarker.csv"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("Maincode,M1\nC1,5\n")
    df = files.scan_dir(spark, d, fmt="csv", header=True)
    named = files.with_file_columns(df, "24-25")
    assert rows(named.select("file_name", "provider")) == [
        ("BWCH 24-25+draft.csv", "BWCH"), ("NoMarker.csv", "NoMarker.csv"), ("ROH 24-25 M04.csv", "ROH")]


def test_ingest_when_every_month_is_after_cutoff(spark):
    d = tempfile.mkdtemp(prefix="staffline-inbox-")
    _land(_wide(spark, "ROH 24-25 M04", 3, ["C1"]), d)
    out = inbox.submissions_long(inbox.read_inbox(spark, d, HEADERS), 202401, "24-25", month_labels=LABELS)
    assert out.count() == 0 and out.columns == list(inbox.LONG_COLUMNS)


def test_empty_inbox_is_a_no_op(spark):
    root = tempfile.mkdtemp(prefix="staffline-empty-")
    src, out, ckpt = (os.path.join(root, n) for n in ("inbox", "fact", "ckpt"))
    os.makedirs(src)
    inbox.stream_inbox(spark, src, out, ckpt, HEADERS, 202407, month_labels=LABELS)
    fact = inbox.read_fact(spark, out)
    assert fact.count() == 0 and fact.columns == list(inbox.LONG_COLUMNS)
