"""Stored stock-loan history (G5): parsed once, extended day by day.

Under one root lie the parsed rows and the timestamped ``history``, both by
``snapshot_date``, the state after each run (``state/snapshot_date=``: the last
representative of every symbol and the last snapshot of every country), and
versions of ``latest``, one row per listing of each country's newest snapshot.

A run parses its files once. It starts from the newest state before its first
day and stamps all days after that state: its own, and those stored already
that come after a late file. No older day is read. Its days replace their partitions, so a run may
be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.names import col as qcol
from shortbook.operators.changes import change_history_incremental
from shortbook.schemas import CHANGE_COLS, SYMBOL_COL
from shortbook.session import hadoop_fs
from shortbook.sources import sinks, snapshots

DAY, TIME = "snapshot_date", "snapshot_time"


class LoanStore:
    def __init__(self, spark: SparkSession, root: str, country: str = "COUNTRY", sym: str = SYMBOL_COL,
                 change_cols: Sequence[str] = CHANGE_COLS):
        self.spark, self.root = spark, root.rstrip("/")
        self.country, self.sym, self.change_cols = country, sym, list(change_cols)

    def days(self, part: str) -> list[str]:
        """Stored days of a part, in order."""
        fs, base = hadoop_fs(self.spark, f"{self.root}/{part}")
        if not fs.exists(base):
            return []
        names = (st.getPath().getName() for st in fs.listStatus(base))
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{DAY}="))

    def append_text(self, snapshot_root: str) -> str:
        """Parse the snapshot files under ``snapshot_root`` (R6-R8) and append them."""
        return self.append(snapshots.parse_snapshot_text(self.spark, snapshot_root))

    def append(self, rows: DataFrame) -> str:
        """Append parsed rows (``snapshot_ts``, ``bof_ts``, ``_order``); returns the
        path of the new ``latest``. A snapshot that is stored already is replaced
        as a whole; the others of its day stay."""
        rows = rows.withColumns({DAY: F.col("snapshot_ts").cast("date"), TIME: F.date_format("snapshot_ts", "HH-mm-ss")})
        staged = sinks.write_parquet(rows, f"{self.root}/staged")
        rows = self.spark.read.parquet(staged)
        new = sorted(str(r[0]) for r in rows.select(DAY).distinct().collect())  # one row a day
        if not new:
            return sinks.latest_version(self.spark, f"{self.root}/latest") or ""
        self._replace(rows, "rows", DAY, TIME)
        return self._stamp(new[0])

    def _replace(self, rows: DataFrame, part: str, *by: str) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
         .parquet(f"{self.root}/{part}"))

    def _stamp(self, first: str) -> str:
        """Timestamps of all days after the newest state before ``first``, the
        state after them, and ``latest``."""
        spark, root = self.spark, self.root
        rows = spark.read.parquet(f"{root}/rows").drop(TIME)
        older = [d for d in self.days("state") if d < first]
        reps = man = None
        if older:
            rows = rows.where(F.col(DAY) > F.lit(older[-1]).cast("date"))
            at = f"{root}/state/{DAY}={older[-1]}"
            reps, man = spark.read.parquet(f"{at}/reps"), spark.read.parquet(f"{at}/manifest")
        out, new_man, new_reps, _ = change_history_incremental(
            rows, man, reps, country=self.country, sym=self.sym, change_cols=self.change_cols)
        self._replace(out, "history", DAY)
        last = self.days("rows")[-1]
        at = f"{root}/state/{DAY}={last}"
        sinks.write_parquet(new_man, f"{at}/manifest")
        sinks.write_parquet(new_reps, f"{at}/reps")
        # states inside the days just stamped are older than these
        fs, _ = hadoop_fs(spark, root)
        for d in self.days("state"):
            if (older[-1] if older else "") < d < last:
                fs.delete(hadoop_fs(spark, f"{root}/state/{DAY}={d}")[1], True)
        return self._publish_latest(at, last)

    def _publish_latest(self, state: str, day: str) -> str:
        reps, man = (self.spark.read.parquet(f"{state}/{part}") for part in ("reps", "manifest"))
        newest = man.select(qcol(self.country).alias("_m_country"), "_last_n", "_last_snapshot")
        now = reps.join(newest, qcol(self.country).eqNullSafe(F.col("_m_country")) & (F.col("_n") == F.col("_last_n")))
        now = now.select(qcol(self.country), qcol(self.sym), *[qcol(c) for c in self.change_cols if c in reps.columns],
                         F.col("_last_snapshot").alias("snapshot_ts"), F.col("_rep_ts").alias("TIMESTAMP"))
        base = f"{self.root}/latest"
        fs, p = hadoop_fs(self.spark, base)
        runs = len(fs.listStatus(p)) if fs.exists(p) else 0
        return sinks.publish_versioned(now, base, f"{runs:06d}-{day}")

    def history(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/history")

    def latest(self) -> DataFrame:
        return self.spark.read.parquet(sinks.latest_version(self.spark, f"{self.root}/latest"))
