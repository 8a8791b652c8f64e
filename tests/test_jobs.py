"""Jobs and sinks: G3/G4 conversion + status, G7 meetings CSV, G8 daily
calendar CSV (K2), K7 archive, P2 head, M2 SQL load."""

import os

from pyspark.sql import functions as F

from shortbook.operators import changes
from shortbook.plans import jobs, registry, views
from shortbook.plans.dataset import TradingDataset
from shortbook.sources import csv as csv_src, sinks
from conftest import rows
from test_sources import FOMC


def test_convert_selected_sources_and_status(spark, sf, tmp_path):
    raw = str(tmp_path / "raw")
    e = views.earnings(spark, sf).drop("SEQ").withColumn("_name", F.lit("earnings_calendar.csv"))
    sinks.write_named_files(e, raw, "_name", "csv", {"header": True})
    out = str(tmp_path / "out")
    res = {r["source"]: r for r in jobs.convert_all(spark, raw, out, ["earnings", "fomc"])}
    assert set(res) == {"earnings", "fomc"}
    assert res["fomc"]["status"] == "missing"
    assert res["earnings"]["status"] == "converted"
    t = spark.read.parquet(res["earnings"]["path"])
    assert dict(t.dtypes)["estimate"] == "double" and t.count() == views.earnings(spark, sf).count()
    status = jobs.status_report(spark, out + "/parquet").collect()
    assert [(r["table"], r["rows"]) for r in status] == [("earnings", t.count())]


def test_meetings_job_writes_csv_or_nothing(spark, tmp_path):
    pages = spark.createDataFrame([(1, FOMC)], "page_id long, html string")
    n = jobs.meetings_job(pages, str(tmp_path / "fomc"))
    assert n == 3
    back = spark.read.option("header", True).csv(str(tmp_path / "fomc"))
    assert back.count() == 3 and "Transcript Release Date" in back.columns
    empty = spark.createDataFrame([(2, "<html></html>")], "page_id long, html string")
    assert jobs.meetings_job(empty, str(tmp_path / "none")) == 0
    assert not os.path.exists(tmp_path / "none")


def test_earnings_calendar_append_is_per_day(spark, tmp_path):
    rec = spark.createDataFrame([("Acme", "ACM", "$1,000", None, "2024-01-02"), ("Beta", "BET", "$2", "$0.5", "2024-01-03")],
                                "name string, symbol string, marketCap string, epsForecast string, day string")
    path = str(tmp_path / "cal")
    jobs.earnings_calendar_job(rec, path, "day", "2024-01-02 10:00:00")
    jobs.earnings_calendar_job(rec.where("day = '2024-01-03'"), path, "day", "2024-01-03 10:00:00")
    jobs.earnings_calendar_job(rec.where("day = 'none'"), path, "day", "x")  # empty: no folder
    days = sorted(p for p in os.listdir(path) if p.startswith("report_date="))
    assert days == ["report_date=2024-01-02", "report_date=2024-01-03"]
    back = csv_src.read_csv_table(spark, path)
    assert back.count() == 3
    assert jobs.read_earnings_calendar(spark, path).count() == 2  # the repeated day collapses
    assert set(back.columns) >= {"Company Name", "Symbol", "Market Cap", "EPS Forecast", "Scraped At"}


def test_archive_snapshots_checks_counts(spark, sf, tmp_path):
    s = views.snapshots(spark, sf).withColumn(
        "folder", F.concat(F.date_format("snapshot_date", "yyyy-MM-dd"), F.lit("_00-00-00"))).drop("snapshot_date")
    plan = sinks.retention_plan(s.select("folder"), s.select("folder"))
    n = sinks.archive_snapshots(s, plan.where("kind = 'resampled'"), str(tmp_path / "archive"))
    latest = s.agg(F.max("folder")).first()[0]
    assert n == s.where(F.col("folder") != latest).count()


def test_head_and_sql_load(spark, sf):
    eng = registry.engine(spark, sf)
    assert eng.head("stock_loan", 7).count() == 7
    ds = TradingDataset(spark, registry.fixture_catalog(spark, sf), ["stock_loan"])
    got = ds.load_sql("SELECT COUNTRY, count(*) AS n FROM stock_loan GROUP BY COUNTRY").df
    assert got.agg(F.sum("n")).first()[0] == views.stock_loan(spark, sf).count()


def test_stock_loan_job_end_to_end(spark, sf, tmp_path):
    raw = registry.snapshot_text_root(spark, sf)
    res = jobs.stock_loan_job(spark, raw, str(tmp_path / "sl"), stamp="2024-02-01_00-00-00")
    t = spark.read.parquet(res["path"])
    assert dict(t.dtypes)["AVAILABLE"] == "double"
    cols = [c for c in t.columns if c != "TIMESTAMP"]
    assert t.count() == t.select(*cols).distinct().count()  # deduped on all but TIMESTAMP
    assert changes.clean_symbols(t).count() == t.count()


def test_quality_per_landed_file(spark, sf, tmp_path):
    from shortbook.functions import text
    from shortbook.operators import quality
    n = views.nasdaq_earnings(spark, sf).select(
        F.concat(F.lit("nasdaq_earnings_"), F.substring("report_date", 1, 7), F.lit(".csv")).alias("_name"),
        F.col("company_name").alias("Company Name"), F.col("symbol").alias("Symbol"),
        F.col("market_cap").alias("Market Cap"), F.col("eps_forecast").alias("EPS Forecast"))
    root = str(tmp_path / "cal")
    files = sinks.write_named_files(n, root, "_name", "csv", {"header": True})
    df = csv_src.read_csv_union(spark, root)
    vals = {"Market Cap": text.clean_numeric("Market Cap"), "EPS Forecast": text.clean_numeric("EPS Forecast")}
    rep = quality.quality_by_file(df, "_file", vals)
    assert rep.count() == len(files)
    assert rep.agg(F.sum("n_rows")).first()[0] == n.count()
    bad = quality.range_violations(df, vals, keep=["_file", "Symbol"])
    failed = {r["_file"] for r in rep.where(~F.col("passed")).collect()}
    assert failed == {r["_file"] for r in bad.select("_file").distinct().collect()}


def test_dataset_to_numpy_is_bounded(spark, sf):
    import pytest
    ds = TradingDataset(spark, registry.fixture_catalog(spark, sf), ["stock_loan"]).load(limit=40)
    x, y = ds.to_numpy(["FEERATE", "AVAILABLE"], "FEERATE")
    assert x.shape == (40, 2) and x.dtype.name == "float32" and y.shape == (40,)
    with pytest.raises(ValueError):
        ds.to_numpy(max_rows=10)


def test_versioned_publish_and_catalog_resolution(spark, tmp_path):
    from shortbook.sources.catalog import Catalog
    base = str(tmp_path / "pub" / "stock_loan")
    sinks.publish_versioned(spark.range(3), base, "20240101000000")
    sinks.publish_versioned(spark.range(5), base, "20240102000000")
    os.makedirs(tmp_path / "pub" / "stock_loan" / "v=20240103000000")  # incomplete: no _SUCCESS
    assert sinks.latest_version(spark, base).endswith("v=20240102000000")
    cat = Catalog(spark, {"stock_loan": base})
    assert cat.read("stock_loan").count() == 5
    assert spark.read.parquet(base + "/v=20240101000000").count() == 3  # old version untouched


def test_register_sources_continues_past_failures(spark, tmp_path):
    from shortbook.sources.catalog import Catalog
    good = str(tmp_path / "good.parquet")
    spark.range(2).write.parquet(good)
    cat = Catalog(spark, {"good": good, "missing": str(tmp_path / "nope.parquet")})
    ok, failed = cat.register_sources(["good", "missing"])
    assert ok == ["good"] and failed == ["missing"]
    assert spark.sql("SELECT count(*) AS n FROM good").first()["n"] == 2


def test_local_source_preferred_over_remote(spark, tmp_path):
    from shortbook.sources.catalog import Catalog
    spark.range(4).write.parquet(str(tmp_path / "local" / "earnings.parquet"))
    cat = Catalog(spark, local_dir=str(tmp_path / "local"), remote_base="s3a://bucket/trading_data")
    assert cat.uri("earnings").endswith("local/earnings.parquet")
    assert cat.uri("fomc") == "s3a://bucket/trading_data/fomc.parquet"


def test_symbol_and_params_are_values_not_sql(spark, sf):
    eng = registry.engine(spark, sf)
    assert eng.ticker_history("u1' OR '1'='1").count() == 0
    assert eng.ticker_history("u1").count() > 0
    eng.register_sources(["stock_loan"])
    got = eng.sql("SELECT count(*) AS n FROM stock_loan WHERE SYM = ?", ["U1' OR '1'='1"]).first()["n"]
    assert got == 0


def test_full_run_goes_on_without_a_ledger(spark, tmp_path):
    """A ledger that cannot be written costs the tracking, not the tables."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "earnings_calendar.csv").write_text(
        "symbol,name,reportDate,fiscalDateEnding,estimate,currency\nA,Acme,2025-01-02,2024-12-31,N/A,USD\n")
    blocked = tmp_path / "ledger"
    blocked.write_text("a file where the ledger's folder should be")
    out = jobs.full_run(spark, str(raw), str(tmp_path / "out"), str(blocked), ["earnings"]).collect()
    assert [(r.run_id, r.source, r.status, r.rows) for r in out] == [(None, "earnings", "converted", 1)]
    row = spark.read.parquet(out[0].path).first()
    assert row["estimate"] is None and row["symbol"] == "A"
    off = jobs.full_run(spark, str(raw), str(tmp_path / "out2"), str(tmp_path / "none"), ["earnings"], track=False)
    assert off.first().status == "converted" and not (tmp_path / "none").exists()


def test_earnings_and_meetings_land_in_parts(spark, tmp_path, monkeypatch):
    """No task holds all of a table: it lands in as many files as it is read by
    tasks, and is converted whole."""
    orders = spark.range(1, 401, 1, 4).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("o_custkey"),
        (F.col("id") * 100.5).alias("o_totalprice"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 90).cast("int")).cast("timestamp_ntz").alias("o_orderdate"))
    table = views.table
    monkeypatch.setattr(views, "table", lambda s, sf, name: orders if name == "orders" else table(s, sf, name))
    landed = registry.land_raw_sources(spark, "/root/testdata/sf0.001")
    found = {r["source"]: r for r in jobs.convert_all(spark, landed, str(tmp_path / "out"), ["earnings", "fomc"])}
    for source, name, want in (("earnings", "earnings_calendar.csv", views.earnings(spark, "").drop("SEQ")),
                               ("fomc", "fomc_meeting_times.csv", registry.q_meeting_flags(spark, "").drop("o_orderkey"))):
        parts = csv_src.file_heads(spark, f"{landed}/{name}", None)
        sizes = [spark.read.text(path).count() - 1 for path, _, _ in parts]
        assert len(parts) == 4 and sum(sizes) == want.count() and max(sizes) <= 100
        got = spark.read.parquet(found[source]["path"])
        assert found[source]["rows"] == want.count()
        assert rows(got.select(*[F.col(c).cast("string") for c in want.columns])) == rows(
            want.select(*[F.col(c).cast("string") for c in want.columns]))


def test_an_empty_table_lands_nothing(spark, tmp_path):
    registry._land_table(spark.range(0).selectExpr("cast(id as string) a"), str(tmp_path / "none.csv"))
    assert not (tmp_path / "none.csv").exists()


def test_a_folder_of_parts_with_newlines_is_one_table(spark, tmp_path, monkeypatch):
    want = [("1", "a\nb"), ("2", "c"), ("3", 'd "x"\n\ne'), ("4", "f")]
    df = spark.createDataFrame(want, "id string, note string").repartition(3, "id")
    sinks.write_csv(df, str(tmp_path / "parts.csv"))
    quoted = []
    read = csv_src.read_quoted
    monkeypatch.setattr(csv_src, "read_quoted", lambda *a, **k: quoted.append(a[1]) or read(*a, **k))
    assert rows(csv_src.read_csv_table(spark, str(tmp_path / "parts.csv"))) == want
    assert len(quoted) == 1 and len(quoted[0]) > 1  # not each file whole by one task


def test_unfinished_index_version_is_not_read(spark, tmp_path):
    from shortbook.operators.ledger import Ledger
    led = Ledger(spark, str(tmp_path / "led"))
    t = spark.createDataFrame([("A",), ("B",)], "ticker string")
    for k in range(4):
        led.index_tickers(f"r{k}", "s", t)
    import os
    os.makedirs(f"{led.index_root}/v=99999999999999999999")
    assert {(r.ticker, r.last_run_id) for r in led.ticker_index().collect()} == {("A", "r3"), ("B", "r3")}


def test_index_writes_only_touched_buckets(spark, tmp_path, monkeypatch):
    import os

    from shortbook.operators import ledger as L
    monkeypatch.setattr(L, "INDEX_BUCKETS", 8)
    led = L.Ledger(spark, str(tmp_path / "led"))
    many = spark.createDataFrame([(f"T{k}",) for k in range(200)], "ticker string")
    led.index_tickers("r1", "a", many)
    led.index_tickers("r2", "b", many)
    before = {(r.source, r.bucket): r.path for r in led._manifest()}
    assert len(before) == 16
    led.index_tickers("r3", "a", many.where("ticker = 'T7'"))
    after = {(r.source, r.bucket): r.path for r in led._manifest()}
    changed = [k for k in after if after[k] != before[k]]
    assert len(changed) == 1 and changed[0][0] == "a" and after.keys() == before.keys()
    got = {(r.ticker, r.source): r.last_run_id for r in led.ticker_index().collect()}
    assert len(got) == 400 and got["T7", "a"] == "r3" and got["T7", "b"] == "r2" and got["T8", "a"] == "r1"
    # nothing to write, and what no manifest names any more is gone
    assert led.index_tickers("r4", "a", many.limit(0)).endswith(os.path.basename(led._newest_manifest()))
    assert {(r.source, r.bucket): r.path for r in led._manifest()} == after
    led.index_tickers("r5", "a", many)
    led.index_tickers("r6", "a", many)
    assert not os.path.exists(before["a", 0]) and os.path.exists(before["b", 0])
    assert led.ticker_index().count() == 400
    # another number of buckets holds for new sources only
    monkeypatch.setattr(L, "INDEX_BUCKETS", 3)
    led.index_tickers("r7", "a", many)
    led.index_tickers("r7", "c", many)
    assert {(r.source, r.buckets) for r in led._manifest()} == {("a", 8), ("b", 8), ("c", 3)}
    assert led.ticker_index().count() == 600


def test_filings_job_keeps_what_is_there(spark, tmp_path):
    raw = tmp_path / "raw" / "financial_filings"
    raw.mkdir(parents=True)
    (raw / "10-K_filings_2024_Q1.csv").write_text("cik,company,accession_number\n320193,Acme,0000-1\n5,Other,0000-2\n")
    run = lambda n: jobs.convert_all(spark, str(tmp_path / "raw"), str(tmp_path / f"out{n}"), ["edgar_filings"])[0]
    first = spark.read.parquet(run(1)["path"])
    assert "ticker" not in first.columns  # no map has landed
    assert {r.filing_link for r in first.collect()} == {
        f"https://www.sec.gov/Archives/edgar/data/{c}/{a}.txt" for c, a in (("320193", "0000-1"), ("5", "0000-2"))}
    (tmp_path / "raw" / "company_tickers.json").write_text(
        '{"0": {"cik_str": 320193, "ticker": "OLD"}, "10": {"cik_str": 320193, "ticker": "ACME"}, "9": {"cik_str": 320193, "ticker": "MID"}}')
    second = spark.read.parquet(run(2)["path"])
    assert second.columns[:3] == ["cik", "company", "ticker"]
    assert {(r.cik, r.ticker) for r in second.collect()} == {("320193", "ACME"), ("5", None)}
    (raw / "10-K_filings_2024_Q1.csv").write_text("cik,company,ticker,accession_number,filing_link\n320193,Acme,OWN,0000-1,own\n")
    third = spark.read.parquet(run(3)["path"]).first()
    assert (third.ticker, third.filing_link, third.filing_type) == ("OWN", "own", "10-K")
