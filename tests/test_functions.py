"""Scalar expressions (V1, V5, V8, V10-V12) and the ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shortbook.functions import calendar, sizes, text
from shortbook.operators import ledger


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_zfill_never_truncates(spark):
    df = one_col(spark, ["123", "12345678901", "-12", None])
    assert [r[0] for r in df.select(text.zfill("v", 10)).collect()] == [
        "0000000123", "12345678901", "-000000012", None]


def test_money_cleaning(spark):
    df = one_col(spark, ["$1,234", "($1.19)", "N/A", "", "$-3", "1e5", None])
    got = df.select(text.clean_numeric("v"), text.clean_money("v"), text.clean_numeric("v", remove_dollar=False)).collect()
    assert [tuple(r) for r in got] == [
        (1234.0, 1234.0, None), (1.19, -1.19, None), (None, None, None), (None, None, None),
        (-3.0, -3.0, None), (100000.0, 100000.0, 100000.0), (None, None, None)]


@pytest.mark.parametrize("size,expected", [
    (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10 * 1024 * 1024, "10 MB"),
    (13 * 1024 ** 3, "13 GB"), (-20000, "-20 kB"), (20478 * 512, "10239 kB"), (20479 * 512, "10 MB")])
def test_size_pretty(spark, size, expected):
    df = one_col(spark, [size], "long")
    assert df.select(sizes.size_pretty("v")).first()[0] == expected


def test_mondays_and_holidays(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 2, 1))], "start date, end date")
    cal = calendar.mondays(b)
    got = calendar.first_business_days(cal, calendar.holiday_table(cal))
    assert sorted(tuple(r) for r in got.select("monday", "first_business_day").collect()) == [
        (dt.date(2024, 1, 1), dt.date(2024, 1, 2)),    # New Year's Day
        (dt.date(2024, 1, 8), dt.date(2024, 1, 8)),
        (dt.date(2024, 1, 15), dt.date(2024, 1, 16)),  # MLK day
        (dt.date(2024, 1, 22), dt.date(2024, 1, 22)),
        (dt.date(2024, 1, 29), dt.date(2024, 1, 29))]
    not_monday = spark.createDataFrame([(dt.date(2024, 1, 2), dt.date(2024, 3, 1))], "start date, end date")
    assert calendar.mondays(not_monday).count() == 0
    empty = spark.createDataFrame([(dt.date(2024, 3, 4), dt.date(2024, 3, 1))], "start date, end date")
    assert calendar.mondays(empty).count() == 0


def test_ledger_round_trip(spark, tmp_path):
    led = ledger.Ledger(spark, str(tmp_path / "ledger"))
    r1 = led.start_run("stock_loan", "convert_upload")
    led.log_file(r1, "s3://b/stock_loan.parquet", "stock_loan", 10, 20000, {"SYM": "string"})
    led.finish_run(r1, "success", 10, 1)
    r2 = led.start_run("stock_loan", "convert_upload")
    runs = led.runs()
    state = {r["run_id"]: (r["status"], r["rows_processed"], r["finished_at"] is not None) for r in runs.collect()}
    assert state == {r1: ("success", 10, True), r2: ("running", 0, False)}
    assert ledger.latest_run(runs).first()["run_id"] == r2
    cat = ledger.data_catalog(led.files(), runs).collect()
    assert [(c["size"], c["run_status"]) for c in cat] == [("20 kB", "success")]
    t = spark.createDataFrame([("AAPL",), ("MSFT",)], "ticker string")
    led.index_tickers(r1, "stock_loan", t)
    led.index_tickers(r2, "stock_loan", spark.createDataFrame([("AAPL",)], "ticker string"))
    idx = {r["ticker"]: r["last_run_id"] for r in led.ticker_index().collect()}
    assert idx == {"AAPL": r2, "MSFT": r1}
    assert ledger.run_history(runs, "stock_loan", 1).first()["run_id"] == r2


def test_distinct_tickers_picks_first_symbol_column(spark):
    df = spark.createDataFrame([("a", "X"), ("a", None), ("b", "Y")], "Symbol string, SYM string")
    assert rows(ledger.distinct_tickers(df)) == [("a",), ("b",)]
    assert ledger.distinct_tickers(df.select(F.col("SYM").alias("other"))) is None


def test_meeting_flag_cases(spark):
    from shortbook.plans import jobs
    raw = spark.createDataFrame([
        (2024, "March", "15*", None, None), (2024, "April", "3 (unscheduled)", None, None),
        (2024, "May", "17-18* (cancelled)", None, None), (2024, "June", "22 (notation vote)", None, None),
        (2024, None, "9", None, None), (2024, "July", "(Cancelled)", None, None)],
        "Year int, Month string, Dates string, minutes_text string, href string")
    got = rows(jobs.meeting_rows(raw), ["Month", "Dates", "Summary of Economic Projections", "Unscheduled",
                                        "Cancelled", "Notation Vote"])
    assert got == sorted([("March", "15", True, False, False, False), ("April", "3", False, True, False, False),
                          ("May", "17-18", True, False, True, False), ("June", "22", False, False, False, True)],
                         key=repr)


def test_dotted_column_names_resolve(spark):
    from shortbook.operators import relational
    df = spark.createDataFrame([("A", None), ("B", "3"), (None, "4")], "`SYM` string, `No. of ESTs` string")
    assert relational.dropna(df, ["No. of ESTs"]).count() == 2
    assert relational.filter_tickers(df, ["a"]).count() == 1


def test_long_ticker_lists_use_semi_join(spark):
    from conftest import plan_text
    from shortbook.operators import relational
    df = spark.createDataFrame([("U1",), ("U2",), (None,), ("u3",)], "SYM string")
    many = [f"u{i}" for i in range(1, 1200)]
    kept = relational.filter_tickers(df, many)
    assert "LeftSemi" in plan_text(kept)
    assert sorted(r[0] for r in kept.collect()) == ["U1", "U2"]  # data is not case-folded
    train, test = relational.ticker_split(df, many)
    assert sorted(r[0] for r in test.collect()) == ["U1", "U2"]
    assert sorted((r[0] or "") for r in train.collect()) == ["", "u3"]  # null symbol goes to train


def test_numbers_reject_java_suffixes(spark):
    from shortbook.functions.text import clean_numeric, to_double
    from shortbook.operators.relational import coerce_types
    from pyspark.sql import types as T
    df = spark.createDataFrame([(x,) for x in ("5d", "1.5F", "7", " 8.5 ", "-.5", "1e3", "abc", "NaN", None, "1,000")],
                               "x string")
    want = [None, None, 7.0, 8.5, -0.5, 1000.0, None, None, None]
    got = df.select(to_double("x").alias("a"), clean_numeric("x").alias("b")).collect()
    assert [r.a for r in got][:9] == want and got[9].b == 1000.0 and got[0].b is None
    assert [r.x for r in coerce_types(df, {"x": T.DoubleType()}).collect()][:9] == want
