"""Calendar CSVs as the collectors leave them: the earnings range check, the
null rules, the types of a meetings file, and repeats under dotted headers."""

import csv

import pytest
from pyspark.sql import functions as F

from shortbook.functions import text
from shortbook.operators import changes, quality
from shortbook.schemas import FOMC_SCHEMA
from shortbook.sources import csv as csv_src

HEADER = ["Company Name", "Symbol", "Market Cap", "EPS Forecast", "No. of ESTs", "Scraped At"]


@pytest.fixture
def calendar(tmp_path):
    """Three days; one forecast out of range, null tokens, a ticker called NA."""
    days = {
        "cal_2025-03-25.csv": [("Nano Inc", "NA", "$1,000,000,000", "$0.10", "N/A", "t1"),
                               ("Other, Inc", "OTH", "$2,000,000,000", "($1.19)", "3", "t1"),
                               ("Other, Inc", "OTH", "$2,000,000,000", "($1.19)", "3", "t2")],
        "cal_2025-04-22.csv": [("Big Corp", "BIG", "$9,000,000,000", "$107.87", "", "t1")],
        "cal_2025-04-23.csv": [('Say "Hi" Ltd', "HI", "N/A", "", "NULL", "t1")],
    }
    for name, rows in days.items():
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f).writerows([HEADER, *rows])
    return str(tmp_path)


def test_range_check(spark, calendar):
    df = csv_src.read_csv_union(spark, calendar)
    vals = {"Market Cap": text.clean_numeric("Market Cap"), "EPS Forecast": text.clean_numeric("EPS Forecast")}
    rep = quality.quality_by_file(df, "_file", vals)
    assert (rep.count(), df.count(), rep.where("passed").count()) == (3, 5, 2)
    bad = [tuple(r) for r in quality.range_violations(df, vals, keep=["_file", "Symbol"]).select(
        "_file", "Symbol", "field", "value").collect()]
    assert bad == [("cal_2025-04-22.csv", "BIG", "EPS Forecast", 107.87)]


def test_null_rules(spark, calendar):
    def nulls(df):
        return [df.where(F.col(f"`{c}`").isNull()).count() for c in ("No. of ESTs", "Market Cap", "Symbol")]
    assert nulls(csv_src.read_csv_union(spark, calendar)) == [1, 0, 0]
    assert nulls(csv_src.read_csv_union(spark, calendar, na_compat=True)) == [3, 1, 0]


def test_repeats_collapse_with_keep_last(spark, calendar):
    df = csv_src.read_csv_union(spark, calendar).drop("_file")
    out = changes.dedupe_keep_last(df, "Scraped At", ts_col="Scraped At")
    assert df.count() - out.count() == 1
    assert [r["Scraped At"] for r in out.where("Symbol = 'OTH'").collect()] == ["t2"]


def test_meetings_file_types(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(",".join(FOMC_SCHEMA.names) + "\n"
                    "2024,January,30-31,True,False,False,False,http://x,\"February 21, 2024\"\n"
                    "2024,March,19,False,True,False,False,,\n")
    df = csv_src.read_csv_table(spark, str(path), {f.name: f.dataType for f in FOMC_SCHEMA})
    assert df.schema.simpleString() == FOMC_SCHEMA.simpleString()
    assert [(r["Year"], r["Unscheduled"], r["Transcript Release Date"]) for r in df.collect()] == [
        (2024, False, "February 21, 2024"), (2024, True, None)]
