"""Jobs (G1-G9): landed raw files -> typed tables -> Parquet -> ledger.

Each job is a function over DataFrames or paths; there is no scheduler.
A missing input makes a source 'missing', a failing source is recorded as
'failed' and the others continue.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortbook.functions import calendar, meetings
from shortbook.functions.text import filing_link, zfill
from shortbook.operators import changes, joins, ledger as ledger_ops, relational
from shortbook.schemas import ATS_TYPES, EARNINGS_TYPES, FOMC_SCHEMA, STOCK_LOAN_RENAMES, STOCK_LOAN_TYPES
from shortbook.session import hadoop_fs
from shortbook.sources import csv as csv_src
from shortbook.sources import jsonsrc, sinks, snapshots

log = logging.getLogger(__name__)


# ------------------------------------------------------------------ G5

def stock_loan_history(spark: SparkSession, snapshot_root: str) -> DataFrame:
    """Parse every snapshot (R6-R8) and timestamp changes."""
    rows = snapshots.parse_snapshot_text(spark, snapshot_root)
    return changes.change_history(rows, snapshot="snapshot_ts", snapshot_time="bof_ts", order="_order")


def stock_loan_job(spark: SparkSession, snapshot_root: str, out_root: str, stamp: str | None = None,
                   publish_stamp: str | None = None) -> dict:
    """Process -> resample (D2 + D1) -> compile (D3) -> normalise,
    coerce, write ``stock_loan`` Parquet (K4 + K1)."""
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d_%H-%M-%S")
    hist = stock_loan_history(spark, snapshot_root)
    cleaned = changes.clean_symbols(hist).drop("snapshot_ts", "bof_ts", "file_path")
    # D1 keep-last over all columns but TIMESTAMP, in (snapshot, file, line) order
    master = changes.dedupe_keep_last(cleaned, "_order")
    resampled = sinks.write_snapshot_parquet(master, f"{out_root}/resampled", stamp)
    table = relational.normalise_columns(spark.read.parquet(resampled), STOCK_LOAN_RENAMES)
    table = relational.coerce_types(table, STOCK_LOAN_TYPES, timestamp_col="TIMESTAMP")
    path, rows = _publish(table, f"{out_root}/parquet/stock_loan", publish_stamp or stamp.replace("-", "").replace("_", ""))
    return {"source": "stock_loan", "path": path, "rows": rows, "resampled": resampled}


# ------------------------------------------------------------------ G6

def enrich_filings(filings: DataFrame, ticker_map: DataFrame, cik_col: str = "cik") -> DataFrame:
    """Filing link (unpadded CIK), ticker by padded CIK (J2, last map
    entry wins), ticker placed right after ``company`` (P13)."""
    f = filings.withColumn("filing_link", filing_link(F.col(cik_col), F.col("accession_number")))
    f = joins.add_cik_tickers(f, ticker_map, cik_col)
    return relational.move_after(f, "ticker", "company")


def read_ticker_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The landed map of companies (objects keyed by position) as (cik_str
    with ten digits, ticker, pos)."""
    m = jsonsrc.read_keyed_objects(spark, path, "cik_str string, ticker string", "pos", lines)
    return m.select(zfill(F.col("cik_str"), 10).alias("cik_str"), "ticker", F.col("pos").try_cast("long").alias("pos"))


def with_link_and_ticker(filings: DataFrame, ticker_map: DataFrame | None) -> DataFrame:
    """G6 for landed filings: what they already carry stays, a missing link is
    made, a missing ticker is looked up where there is a map."""
    if not {"cik", "accession_number"} <= set(filings.columns):
        return filings
    if "filing_link" not in filings.columns:
        filings = filings.withColumn("filing_link", filing_link(F.col("cik"), F.col("accession_number")))
    if "ticker" in filings.columns or ticker_map is None:
        return filings
    return relational.move_after(joins.add_cik_tickers(filings, ticker_map), "ticker", "company")


def filings_job(spark: SparkSession, filings_root: str, map_path: str | None, out_base: str,
                stamp: str | None = None, map_lines: bool = False) -> dict:
    """G6 as a job: landed filings of every form and quarter -> link and ticker
    -> one published version, a folder per form."""
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    ticker_map = read_ticker_map(spark, map_path, map_lines) if map_path else None
    table = with_link_and_ticker(csv_src.read_filings(spark, filings_root), ticker_map)
    path, rows = _publish(table, out_base, stamp, ["filing_type"])
    return {"source": "edgar_filings", "path": path, "rows": rows}


# ------------------------------------------------------------------ G7

def meeting_rows(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """G7 body: raw (Year, Month, Dates, minutes_text, href) -> meeting
    table with flags, transcript link and release date; incomplete rows
    dropped."""
    df = meetings.meeting_flags(raw, "Dates")
    df = meetings.keep_complete(df)
    return df.select(
        *keep, F.col("Year").try_cast("long").alias("Year"), "Month", "Dates",
        "Summary of Economic Projections", "Unscheduled", "Cancelled", "Notation Vote",
        meetings.transcript_link("href").alias("Transcript HTML Link"),
        meetings.release_date("minutes_text").alias("Transcript Release Date"),
    )


def meetings_job(pages: DataFrame, out_path: str) -> int:
    """Pages -> meeting rows -> CSV; nothing is written when empty. Pages
    that cannot be read are logged with their number, not dropped in silence."""
    from shortbook.sources import html
    raw = html.meeting_records(pages)
    failed = raw.where(F.col("error").isNotNull())
    if n_failed := failed.count():
        log.warning("%d meeting pages could not be read, e.g. %s", n_failed, failed.first()["error"])
    rows = meeting_rows(raw)
    if rows.isEmpty():
        return 0
    sinks.write_csv(rows, out_path)
    return rows.count()


# ------------------------------------------------------------------ G8

def earnings_calendar_job(records: DataFrame, out_path: str, date_col: str, scraped_at: str) -> str:
    """API records -> daily CSV (header names of the calendar files),
    appended per day (K2). Missing fields become empty text."""
    from shortbook.schemas import NASDAQ_RECORD_FIELDS
    cols = [F.coalesce(F.col(f), F.lit("")).alias(h) for f, h in NASDAQ_RECORD_FIELDS if f in records.columns]
    out = records.select(*cols, F.lit(scraped_at).alias("Scraped At"), F.col(date_col).alias("report_date"))
    return sinks.append_daily_csv(out, out_path, "report_date")


def read_earnings_calendar(spark: SparkSession, path: str) -> DataFrame:
    """K2 + D1: the appended daily calendar, one row per distinct record
    (every column but ``Scraped At``), keeping the latest scrape -- so a
    repeated append of the same day never duplicates rows."""
    from shortbook.sources import csv as csv_read
    df = csv_read.read_csv_table(spark, path)
    return changes.dedupe_keep_last(df, "Scraped At", ts_col="Scraped At")


# ------------------------------------------------------------------ G9

def otc_filter_date(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """V10 + J5: the last first-business-day of the weeks in ``bounds``
    (one row: ``fd`` as 'yyyy-MM-dd')."""
    cal = calendar.mondays(bounds)
    hol = holidays if holidays is not None else calendar.holiday_table(cal)
    fbd = calendar.first_business_days(cal, hol)
    return fbd.agg(F.max("first_business_day").cast("string").alias("fd"))


def otc_latest_week(ats: DataFrame, bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Rows of the latest filter date only. An equi-join with the
    one-row date (no literal needed) lets dynamic partition pruning skip
    other weeks when ``ats`` is partitioned by publish date."""
    target = F.broadcast(otc_filter_date(bounds, holidays))  # one row (a global aggregate)
    return ats.join(target, ats["initialPublishedDate"] == target["fd"], "left_semi")


# ------------------------------------------------------------------ G1-G4

def _path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def convert_all(spark: SparkSession, raw_root: str, out_root: str, sources: Sequence[str] | None = None,
                stamp: str | None = None) -> list[dict]:
    """Every source from its landed files to one Parquet dataset,
    published as a new version ``{out}/parquet/{source}/v={stamp}`` (never
    over the table readers use). Sources are filtered *before* reading.
    Missing input -> 'missing'."""
    raw = raw_root.rstrip("/")
    out = out_root.rstrip("/")
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")

    tickers = f"{raw}/company_tickers.json"

    def _write(df, base, partition_by=()):
        return _publish(df, base, stamp, partition_by)

    plan = {
        "stock_loan": (f"{raw}/stock_loan", lambda p: (lambda r: (r["path"], r["rows"]))(
            stock_loan_job(spark, p, out, publish_stamp=stamp))),
        "earnings": (f"{raw}/earnings_calendar.csv", lambda p: _write(
            csv_src.read_csv_table(spark, p, EARNINGS_TYPES, na_compat=True), f"{out}/parquet/earnings")),
        "nasdaq_earnings": (f"{raw}/nasdaq_earnings_upload", lambda p: _write(
            csv_src.read_csv_union(spark, p, na_compat=True).drop("_file"), f"{out}/parquet/nasdaq_earnings")),
        "fomc": (f"{raw}/fomc_meeting_times.csv", lambda p: _write(
            csv_src.read_csv_table(spark, p, {f.name: f.dataType for f in FOMC_SCHEMA}, na_compat=True),
            f"{out}/parquet/fomc")),
        "ats_otc": (f"{raw}/ats_upload", lambda p: _write(
            csv_src.read_csv_union(spark, p, ATS_TYPES), f"{out}/parquet/ats_otc",
            ["initialPublishedDate"])),
        "edgar_filings": (f"{raw}/financial_filings", lambda p: (lambda r: (r["path"], r["rows"]))(
            filings_job(spark, p, tickers if _path_exists(spark, tickers) else None,
                        f"{out}/parquet/edgar_filings", stamp))),
    }
    results = []
    for name, (src, fn) in plan.items():
        if sources is not None and name not in sources:
            continue
        if not _path_exists(spark, src):
            results.append({"source": name, "status": "missing", "path": None})
            continue
        try:
            path, rows = fn(src)
            results.append({"source": name, "status": "converted", "path": path, "rows": rows})
        except Exception as e:  # noqa: BLE001 - one source failing must not stop the rest
            log.error("convert failed for %s: %s", name, e)
            results.append({"source": name, "status": "failed", "path": None, "error": str(e)})
    return results


def _publish(df: DataFrame, base: str, stamp: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """K1 as a new version, with the row count observed during the write
    itself (no re-read). Date-like partition columns let later reads prune
    (e.g. G9's week)."""
    from pyspark.sql import Observation
    obs = Observation(f"rows_{abs(hash((base, stamp)))}")
    path = sinks.publish_versioned(df.observe(obs, F.count(F.lit(1)).alias("rows")), base, stamp, partition_by)
    return path, int(obs.get["rows"])


def full_run(spark: SparkSession, raw_root: str, out_root: str, ledger_root: str,
             sources: Sequence[str] | None = None, track: bool = True) -> DataFrame:
    """Convert -> publish -> log files -> index tickers -> finish.
    Counts are observed while the tables are written. Ends 'success',
    'partial' (some source failed) or 'failed' (none converted). The tables
    matter more than the ledger: when it cannot be written, or ``track`` is
    off, the run goes on without it and its rows have no run id."""
    tracker = _Tracker(spark, ledger_root if track else None)
    tracker.call("start", "all" if sources is None else ",".join(sources))
    results = convert_all(spark, raw_root, out_root, sources)
    for r in results:
        if r["status"] == "converted":
            tracker.call("log", r)
    failed = any(r["status"] == "failed" for r in results)
    done = any(r["status"] == "converted" for r in results)
    tracker.call("finish", "failed" if failed and not done else ("partial" if failed else "success"), done)
    schema = "run_id string, source string, status string, path string, rows long"
    return spark.createDataFrame(
        [(tracker.run_id, r["source"], r["status"], r.get("path"), r.get("rows")) for r in results], schema)


class _Tracker:
    """The ledger of one run; its first failure ends the tracking, not the run."""

    def __init__(self, spark: SparkSession, root: str | None):
        self.spark, self.run_id = spark, None
        self.ledger = ledger_ops.Ledger(spark, root) if root else None

    def call(self, step: str, *args) -> None:
        if self.ledger is None:
            return
        try:
            getattr(self, f"_{step}")(*args)
        except Exception as e:  # noqa: BLE001 - whatever the ledger's store raises
            log.warning("run %s goes on without tracking: %s", self.run_id, e)
            self.ledger = None

    def _start(self, what: str) -> None:
        self.run_id = self.ledger.start_run(what, "convert_upload")

    def _log(self, r: dict) -> None:
        df = self.spark.read.parquet(r["path"])  # schema only; the count came from the write
        fs, p = hadoop_fs(self.spark, r["path"])
        self.ledger.log_file(self.run_id, r["path"], r["source"], r["rows"],
                             int(fs.getContentSummary(p).getLength()),
                             {f.name: f.dataType.simpleString() for f in df.schema})
        if (tickers := ledger_ops.distinct_tickers(df)) is not None:
            self.ledger.index_tickers(self.run_id, r["source"], tickers)

    def _finish(self, status: str, done: bool) -> None:
        rows = files = 0
        if done:  # A4 from the ledger's own file log
            t = ledger_ops.run_totals(self.ledger.files().where(F.col("run_id") == self.run_id)).first()
            rows, files = int(t["rows_processed"]), int(t["files_uploaded"])
        self.ledger.finish_run(self.run_id, status, rows, files)


def status_report(spark: SparkSession, parquet_dir: str) -> DataFrame:
    """Per local Parquet table -- rows (footers), columns, size MB."""
    from shortbook.sources import files
    return files.inventory(spark, parquet_dir)
