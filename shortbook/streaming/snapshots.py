"""Incremental snapshot ingest (S1) and streaming change timestamps.

S1: a file stream over the snapshot folders (``availableNow`` -- the hourly
batch becomes a trigger) parses each new ``.txt`` exactly once into an
append-only history. S2: each micro-batch is timestamped against keyed
state (``change_history_incremental``); the state lives in Parquet tables, a
base and one delta per batch id with the batch's own symbols, so a retried
batch rewrites the same delta and a lost executor only recomputes tasks. Batch C2 over the history is the
oracle for S2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.operators.changes import change_history_incremental, last_per_key
from shortbook.session import hadoop_fs
from shortbook.sources.snapshots import parse_lines, prepare_lines


def snapshot_line_stream(spark: SparkSession, root: str, glob: str = "*.txt",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 source: lines of new files in ``{root}/{YYYY-MM-DD_HH-MM-SS}/``."""
    r = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(f"{root.rstrip('/')}/*/").select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("_blk"),
    )


def _versions(spark: SparkSession, root: str, before: int) -> dict[str, dict[int, str]]:
    """Complete folders ``{kind}={batch}`` under ``root``, by kind, older than ``before``."""
    fs, base = hadoop_fs(spark, root)
    found: dict[str, dict[int, str]] = {"base": {}, "batch": {}}
    for st in fs.listStatus(base) if fs.exists(base) else []:
        kind, _, b = st.getPath().getName().partition("=")
        if kind in found and int(b) < before and fs.exists(st.getPath().suffix("/_SUCCESS")):
            found[kind][int(b)] = st.getPath().toString()
    return found


class DeltaState:
    """One row per key as a base and the deltas after it.

    A batch writes the rows of its own keys only. Every ``compact`` batches the
    newest row of each key becomes a new base, and what is older goes. Reading
    takes the row with the greatest ``order`` of each key; a retried batch
    reads what was there before it and replaces its own delta."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: str, compact: int = 8):
        self.spark, self.root, self.keys, self.order, self.compact = spark, root.rstrip("/"), list(keys), order, compact

    def read(self, batch_id: int) -> DataFrame | None:
        found = _versions(self.spark, self.root, batch_id)
        base = max(found["base"], default=None)
        deltas = {b: p for b, p in found["batch"].items() if base is None or b > base}
        if base is None and not deltas:
            return None
        paths = ([found["base"][base]] if base is not None else []) + list(deltas.values())
        if len(deltas) < self.compact:
            return self._newest(paths)
        newest = max(deltas)
        path = f"{self.root}/base={newest}"
        self._newest(paths).write.mode("overwrite").parquet(path)
        fs, _ = hadoop_fs(self.spark, self.root)
        for old in [p for b, p in found["base"].items() if b != newest] + list(found["batch"].values()):
            fs.delete(hadoop_fs(self.spark, old)[1], True)
        return self.spark.read.parquet(path)

    def _newest(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*paths)
        return last_per_key(rows, self.keys, self.order, [c for c in rows.columns if c not in self.keys])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")


class ChangeTracker:
    """foreachBatch body for S1 + S2 with state under ``state_root``."""

    def __init__(self, spark: SparkSession, out_path: str, state_root: str, compact: int = 8):
        self.spark = spark
        self.out_path = out_path.rstrip("/")
        self.state_root = state_root.rstrip("/")
        self.reps = DeltaState(spark, f"{self.state_root}/reps", ["COUNTRY", "SYM"], "_n", compact)
        self.manifest = DeltaState(spark, f"{self.state_root}/manifest", ["COUNTRY"], "_last_n", compact)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark
        # parsed once, into the shared folder: the four results below read it
        parsed = f"{self.state_root}/parsed"
        parse_lines(prepare_lines(batch)).write.mode("overwrite").parquet(parsed)
        rows = spark.read.parquet(parsed)
        out, man, reps, late = change_history_incremental(
            rows, self.manifest.read(batch_id), self.reps.read(batch_id), delta=True)
        out = out.withColumn("snapshot_date", F.col("snapshot_ts").cast("date"))
        # output first, then state: a crash between them replays this batch
        # (same batch id), which overwrites the same output and state versions.
        out.drop("_order").write.mode("overwrite").partitionBy("snapshot_date").parquet(
            f"{self.out_path}/batch={batch_id}")
        self.reps.write(reps, batch_id)
        self.manifest.write(man, batch_id)
        # snapshots older than the state are never applied; they are counted
        late.write.mode("overwrite").parquet(f"{self.state_root}/late/batch={batch_id}")


def run_change_stream(spark: SparkSession, root: str, out_path: str, checkpoint: str,
                      max_files_per_trigger: int | None = None, compact: int = 8) -> None:
    """Process every file not yet seen under ``root`` and stop (availableNow)."""
    lines = snapshot_line_stream(spark, root, max_files_per_trigger=max_files_per_trigger)
    tracker = ChangeTracker(spark, out_path, f"{checkpoint.rstrip('/')}/state", compact)
    q = (lines.writeStream.foreachBatch(tracker)
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def late_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Late rows (older than the state, not applied) per batch and country."""
    return spark.read.option("basePath", f"{checkpoint.rstrip('/')}/state/late").parquet(
        f"{checkpoint.rstrip('/')}/state/late/batch=*")


def read_history(spark: SparkSession, out_path: str) -> DataFrame:
    """All batches of the tracked history (one folder per batch id)."""
    return spark.read.option("basePath", out_path).parquet(f"{out_path.rstrip('/')}/batch=*")
