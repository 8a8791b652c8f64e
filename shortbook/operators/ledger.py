"""Run / file / ticker ledger on Parquet.

Append-only: a run is a 'start' event and a 'finish' event; the current
state of a run is folded with ``max_by`` (no UPDATE). The ticker index lies
in buckets of each source; an upsert writes the buckets it touches into a new
folder, never over one being read, and a manifest then names every bucket's
folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortbook.names import col as qcol, cols as qcols

from shortbook.functions.sizes import size_pretty
from shortbook.functions.text import new_run_id
from shortbook.session import hadoop_fs

RUN_EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("event", T.StringType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("files_uploaded", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

FILE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("cloud_uri", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("row_count", T.LongType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("schema", T.MapType(T.StringType(), T.StringType())),
    T.StructField("uploaded_at", T.TimestampType()),
])

INDEX_SCHEMA = "ticker string, source string, last_run_id string, last_seen timestamp"
MANIFEST_SCHEMA = "source string, buckets int, bucket int, path string"
# buckets of a source's tickers, fixed by the source's first run
INDEX_BUCKETS = 64


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def events_path(self) -> str:
        return f"{self.root}/run_events"

    @property
    def files_path(self) -> str:
        return f"{self.root}/dataset_files"

    @property
    def index_root(self) -> str:
        return f"{self.root}/ticker_index"

    def _append(self, rows, schema, path):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    # L1
    def start_run(self, source: str, action: str, extra: dict | None = None) -> str:
        run_id = new_run_id()
        self._append([(run_id, "start", source, action, "running", _now(), None, None, None, extra or {})],
                     RUN_EVENT_SCHEMA, self.events_path)
        return run_id

    # L2
    def finish_run(self, run_id: str, status: str = "success", rows_processed: int = 0,
                   files_uploaded: int = 0, error: str | None = None) -> None:
        self._append([(run_id, "finish", None, None, status, _now(), rows_processed, files_uploaded, error, None)],
                     RUN_EVENT_SCHEMA, self.events_path)

    # L3
    def log_file(self, run_id: str, cloud_uri: str, source: str, row_count: int = 0, size_bytes: int = 0,
                 schema: dict | None = None) -> None:
        self._append([(run_id, cloud_uri, source, row_count, size_bytes, schema or {}, _now())],
                     FILE_SCHEMA, self.files_path)

    def run_events(self) -> DataFrame:
        return self.spark.read.schema(RUN_EVENT_SCHEMA).parquet(self.events_path)

    def runs(self) -> DataFrame:
        return runs_state(self.run_events())

    def files(self) -> DataFrame:
        return self.spark.read.schema(FILE_SCHEMA).parquet(self.files_path)

    # L4
    def index_tickers(self, run_id: str, source: str, tickers: DataFrame) -> str | None:
        """Upsert (ticker, source) rows from a one-column DataFrame of tickers.

        Only the buckets of ``source`` in which the tickers fall are read, merged
        and written. The manifest is written last: readers see the index before
        the run or after it. Returns the manifest's folder; without a ticker
        nothing is written."""
        stamp = _now().strftime("%Y%m%d%H%M%S%f")
        held = self._manifest()
        buckets = next((r.buckets for r in held if r.source == source), INDEX_BUCKETS)
        bucket = F.pmod(F.xxhash64("ticker"), F.lit(buckets)).cast("int")
        new = tickers.select(
            F.col(tickers.columns[0]).cast("string").alias("ticker"), F.lit(source).alias("source"),
            F.lit(run_id).alias("last_run_id"), F.lit(_now()).alias("last_seen"))
        # the tickers are computed once; the folders written tell which buckets they touch
        staged = f"{self.index_root}/staged/{stamp}"
        new.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(staged)
        touched = {int(name.partition("=")[2]) for name in self._folders(staged) if name.startswith("bucket=")}
        if touched:
            old = [r.path for r in held if r.source == source and r.bucket in touched]
            merged = upsert_index(self._index_rows(old), self._index_rows([f"{staged}/bucket={b}" for b in touched]))
            data = f"{self.index_root}/data/{stamp}"
            merged.withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(data)
            rows = [tuple(r) for r in held if r.source != source or r.bucket not in touched]
            rows += [(source, buckets, b, f"{data}/bucket={b}") for b in sorted(touched)]
            self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.parquet(f"{self.index_root}/v={stamp}")
            self._drop_old_versions()
        fs, path = hadoop_fs(self.spark, staged)
        fs.delete(path, True)
        return self._newest_manifest()

    def ticker_index(self) -> DataFrame | None:
        """The index of the newest complete manifest; one still being written is not read."""
        held = self._manifest()
        return self._index_rows([r.path for r in held]) if held else None

    def _newest_manifest(self) -> str | None:
        from shortbook.sources.sinks import latest_version
        return latest_version(self.spark, self.index_root)

    def _manifest(self, path: str | None = None) -> list:
        """One row per bucket of a source: their number does not grow with the tickers."""
        path = path or self._newest_manifest()
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(path).collect() if path else []

    def _index_rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        return self.spark.read.schema(INDEX_SCHEMA).parquet(*sorted(paths))

    def _folders(self, path: str) -> list[str]:
        fs, base = hadoop_fs(self.spark, path)
        return [s.getPath().getName() for s in fs.listStatus(base)] if fs.exists(base) else []

    def _drop_old_versions(self, keep: int = 2) -> None:
        """Only the newest manifests stay, the current one and the one that
        readers may still hold, and the buckets that they name."""
        names = sorted(n for n in self._folders(self.index_root) if n.startswith("v="))
        paths = [f"{self.index_root}/{n}" for n in names]
        fs, _ = hadoop_fs(self.spark, self.index_root)
        done = [p for p in paths if "_SUCCESS" in self._folders(p)]
        used = {r.path for p in done[-keep:] for r in self._manifest(p)}
        for old in done[:-keep]:
            for gone in {r.path for r in self._manifest(old)} - used:
                fs.delete(hadoop_fs(self.spark, gone)[1], True)
            fs.delete(hadoop_fs(self.spark, old)[1], True)


def runs_state(events: DataFrame) -> DataFrame:
    """Current state per run: start fields + latest event's status/counts."""
    ordered = F.struct("at", F.when(F.col("event") == "finish", 1).otherwise(0))
    start = events.where(F.col("event") == "start").groupBy("run_id").agg(
        F.max_by(F.struct("source", "action", "at", "extra"), "at").alias("s"))
    last = events.groupBy("run_id").agg(
        F.max_by(F.struct("status", "rows_processed", "files_uploaded", "error", "event", "at"), ordered).alias("l"))
    return start.join(last, "run_id").select(
        "run_id", "s.source", "s.action", "l.status", F.col("s.at").alias("started_at"),
        F.when(F.col("l.event") == "finish", F.col("l.at")).alias("finished_at"),
        F.coalesce("l.rows_processed", F.lit(0)).alias("rows_processed"),
        F.coalesce("l.files_uploaded", F.lit(0)).alias("files_uploaded"),
        "l.error", "s.extra",
    )


def upsert_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """L4: union then keep, per (ticker, source), the most recent sighting.
    A partial aggregate: a hot (ticker, source) is combined map-side."""
    u = old.select("ticker", "source", "last_run_id", "last_seen").unionByName(
        new.select("ticker", "source", "last_run_id", "last_seen"))
    last = F.max_by(F.struct("last_run_id", "last_seen"), F.struct("last_seen", "last_run_id"))
    return u.groupBy("ticker", "source").agg(last.alias("l")).select(
        "ticker", "source", "l.last_run_id", "l.last_seen")


def symbol_column(df: DataFrame) -> str | None:
    """A1: the first column named SYM or SYMBOL (any case)."""
    return next((c for c in df.columns if c.upper() in ("SYM", "SYMBOL")), None)


def distinct_tickers(df: DataFrame) -> DataFrame | None:
    """A1: distinct non-null tickers."""
    c = symbol_column(df)
    if c is None:
        return None
    t = df.select(F.col(c).alias("ticker")).dropna().distinct()
    return t


def latest_per_key(df: DataFrame, key: Sequence[str] | str, order_col: str, cols: Sequence[str]) -> DataFrame:
    """W8 (``DISTINCT ON``): the row with the greatest ``order_col`` per key."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in cols if c not in keys]
    return df.groupBy(*qcols(keys)).agg(F.max_by(F.struct(*qcols(rest)), qcol(order_col)).alias("_r")).select(
        *qcols(keys), *[F.col("_r").getField(c).alias(c) for c in rest])


def latest_run(runs: DataFrame) -> DataFrame:
    """Latest run per source."""
    cols = [c for c in ["run_id", "source", "status", "started_at", "finished_at", "rows_processed",
                        "files_uploaded"] if c in runs.columns]
    return latest_per_key(runs, "source", "started_at", cols)


def data_catalog(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Files joined to their run (inner), human size, newest first.
    Join strategy is left to Catalyst/AQE (runs grows with history)."""
    r = runs.select("run_id", F.col("status").alias("run_status"))
    return files.join(r, "run_id").select(
        "source", "cloud_uri", "row_count", size_pretty("size_bytes").alias("size"), "uploaded_at", "run_status",
    ).orderBy(F.col("uploaded_at").desc_nulls_last(), "source", "cloud_uri")


def latest_files(files: DataFrame, source: str, limit: int = 20) -> DataFrame:
    """T3"""
    return files.where(F.col("source") == source).orderBy(
        F.col("uploaded_at").desc_nulls_last(), "run_id", "cloud_uri").limit(limit)


def run_history(runs: DataFrame, source: str | None = None, limit: int = 50) -> DataFrame:
    """T4"""
    df = runs.where(F.col("source") == source) if source else runs
    return df.orderBy(F.col("started_at").desc_nulls_last(), "run_id").limit(limit)


def run_totals(file_stats: DataFrame) -> DataFrame:
    """A4: rows processed (uploaded sources only) and files uploaded."""
    return file_stats.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows_processed"),
        F.count(F.lit(1)).alias("files_uploaded"),
    )
