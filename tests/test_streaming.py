"""S1 + S2 end to end through the file stream: waves of snapshot files,
one landing late (older than what the state has seen)."""

from pyspark.sql import functions as F

from shortbook.session import scratch_dir
from shortbook.sources import snapshots as snapshot_text
from shortbook.streaming import snapshots as stream


def _land(spark, root, rows):
    df = spark.createDataFrame(rows, "folder string, COUNTRY string, SEQ long, SYM string, AVAILABLE double")
    snapshot_text.write_snapshot_text(df, root, "folder", "COUNTRY", "SEQ", ["SYM", "AVAILABLE"])


def test_stream_waves_and_late_snapshot(spark):
    land, out, ckpt = scratch_dir(spark, "t-land"), scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ckpt")
    _land(spark, land, [("2024-01-01_00-00-00", "US", 1, "A", 1.0), ("2024-01-03_00-00-00", "US", 2, "A", 1.0)])
    stream.run_change_stream(spark, land, out, ckpt)
    _land(spark, land, [("2024-01-02_00-00-00", "US", 3, "A", 5.0)])  # older than the state: late
    stream.run_change_stream(spark, land, out, ckpt)
    _land(spark, land, [("2024-01-04_00-00-00", "US", 4, "A", 1.0)])
    stream.run_change_stream(spark, land, out, ckpt)
    hist = stream.read_history(spark, out)
    got = {r["SYM"] + str(r["snapshot_date"]): str(r["TIMESTAMP"]) for r in hist.collect()}
    assert got == {"A2024-01-01": "2024-01-01 00:00:00", "A2024-01-03": "2024-01-01 00:00:00",
                   "A2024-01-04": "2024-01-01 00:00:00"}
    late = stream.late_counts(spark, ckpt).agg(F.sum("late_rows")).first()[0]
    assert late == 1
