"""Stored forms: history and state by day, split CSV reading, verified
archives, published sets, lookups that skip, interval joins, hot times."""

import datetime as dt
import os
import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from shortbook.operators import changes, joins, ranking
from shortbook.plans.loan_store import LoanStore
from shortbook.session import scratch_dir
from shortbook.sources import csv as csv_src
from shortbook.sources import sinks
from shortbook.streaming.snapshots import DeltaState


def snapshots(spark, days, symbols=6, seed=1):
    """Random rows of one snapshot a day and country, some without a country."""
    rnd = random.Random(seed)
    out, n = [], 0
    for d in days:
        for c in ("US", None):
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
            for k in range(symbols):
                if rnd.random() < 0.8:
                    n += 1
                    out.append((ts, ts, 1000 * d + n, c, f"S{k}", float(rnd.randrange(2)), 1.0, None))
    return spark.createDataFrame(out, "snapshot_ts timestamp_ntz, bof_ts timestamp_ntz, _order long, COUNTRY string, "
                                      "SYM string, AVAILABLE double, FEERATE double, REBATERATE double")


COLS = ["COUNTRY", "SYM", "AVAILABLE", "_order", "snapshot_ts", "TIMESTAMP"]


def test_store_equals_history_and_reads_no_older_day(spark):
    whole = snapshots(spark, range(6))
    day = F.dayofmonth("snapshot_ts")
    store = LoanStore(spark, scratch_dir(spark, "t-store"))
    store.append(whole.where(day <= 2))
    store.append(whole.where(day.isin(4, 5)))
    root = store.root.removeprefix("file:")
    os.rename(f"{root}/rows/snapshot_date=2024-01-01", f"{root}/away")  # a day's run must not need it
    store.append(whole.where(day == 6))
    os.rename(f"{root}/away", f"{root}/rows/snapshot_date=2024-01-01")
    store.append(whole.where(day == 3))  # late: the days after it are stamped again
    want = changes.change_history(whole)
    assert rows(store.history(), COLS) == rows(want, COLS)
    store.append(whole.where(day == 6))  # a repeated run changes nothing
    assert rows(store.history(), COLS) == rows(want, COLS)
    last = want.where(day == 6).groupBy("COUNTRY", "SYM").agg(F.max_by("TIMESTAMP", "_order").alias("TIMESTAMP"))
    assert rows(store.latest(), ["COUNTRY", "SYM", "TIMESTAMP"]) == rows(last)


def test_delta_state_holds_the_batch_and_compacts(spark):
    root = scratch_dir(spark, "t-delta")
    state = DeltaState(spark, root, ["k"], "n", compact=2)
    assert state.read(0) is None
    for b in range(6):
        state.read(b)
        state.write(spark.createDataFrame([(f"k{b}", b), ("all", b), (None, b)], "k string, n long"), b)
        assert spark.read.parquet(f"{root}/batch={b}").count() == 3
    # a retried batch sees what was there before it
    assert state.read(5).where("k = 'all'").first().n == 4
    assert rows(state.read(6)) == rows(spark.createDataFrame(
        [*[(f"k{b}", b) for b in range(6)], ("all", 5), (None, 5)], "k string, n long"))
    assert len(os.listdir(root.removeprefix("file:"))) <= 4


def test_quoted_newlines_across_splits(spark):
    rnd = random.Random(3)
    data = []
    for k in range(900):
        text = "".join(rnd.choice(["a", "é", '"', "\n", ",", " ", "\n\n", '""', "word"]) for _ in range(rnd.randrange(40)))
        data.append((str(k), text or None, "x\ny" if k % 5 else "", None if k % 3 else "plain"))
    df = spark.createDataFrame(data, "`id no` string, text string, b string, c string")
    root = scratch_dir(spark, "t-csv")
    sinks.write_csv(df.coalesce(2), root)
    plain = scratch_dir(spark, "t-csv")
    sinks.write_csv(df.select("`id no`", "c"), plain)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = csv_src._lines(spark, root)
        assert lines.rdd.getNumPartitions() > 6
        back = csv_src.read_csv_union(spark, root).drop("_file")
        assert rows(back) == rows(spark.read.csv(root, header=True, escape='"', multiLine=True))
        assert rows(back) == rows(df.replace("", None, ["b"]))
        back = csv_src.read_csv_union(spark, plain)
        assert rows(back.drop("_file")) == rows(df.select("`id no`", "c")) and "MapInArrow" not in plan_text(back)
        assert back.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archive_refuses_changed_values(spark):
    df = spark.createDataFrame([("2024-01-01", "A", 1.0), ("2024-01-01", "B", None), ("2024-01-02", "A", 2.0)],
                               "folder string, SYM string, v double")
    plan = spark.createDataFrame([("2024-01-01", "archive"), ("2024-01-02", "keep")], "folder string, action string")
    root = scratch_dir(spark, "t-archive")
    assert sinks.archive_snapshots(df, plan, root) == 2
    assert sinks.archive_snapshots(df, plan, root) == 2
    assert sinks.verify_archive(spark, root, df) == 2
    changed = df.where("folder = '2024-01-01'").withColumn("v", F.when(F.col("SYM") == "A", 9.0))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(root)
    with pytest.raises(RuntimeError, match="2024-01-01"):
        sinks.verify_archive(spark, root, df)


def test_half_a_published_set_is_not_seen(spark, monkeypatch):
    root = scratch_dir(spark, "t-set")
    assert sinks.read_set(spark, root) == {}
    sinks.publish_set(spark, {"a": spark.range(2), "b": spark.range(3)}, root, "1")
    with pytest.raises(Exception, match="no such"):
        sinks.publish_set(spark, {"a": spark.range(7), "b": spark.range(1).select(F.raise_error(F.lit("no such")))}, root, "2")
    assert {n: t.count() for n, t in sinks.read_set(spark, root).items()} == {"a": 2, "b": 3}


def test_stored_lookup_skips_row_groups(spark):
    df = spark.range(60_000).select(F.concat(F.lit("u"), F.col("id") % 300).alias("SYM"), "id")
    path = sinks.write_lookup(df.repartition(4), scratch_dir(spark, "t-lookup"), "SYM", ["id"])
    found = sinks.read_lookup(spark, path, "U17")
    assert "EqualTo(_folded,U17)" in plan_text(found)
    assert found.count() == 200 and set(found.columns) == {"SYM", "id"}
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() <= 30_000


def test_interval_join_equals_its_definition(spark):
    rnd = random.Random(7)
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 40))
    left = [(rnd.choice(["A", "B", None]), day() if rnd.random() < 0.95 else None, k) for k in range(150)]
    right = [(rnd.choice(["A", "A", "B", None]), day(), k) for k in range(150)]
    a = spark.createDataFrame(left, "k string, t timestamp_ntz, bucket long")
    b = spark.createDataFrame(right, "k string, t timestamp_ntz, rt long")
    for before, after in ((2, 1), (0, 0), (0, 5)):
        got = joins.interval_join(a, b, ["k"], "t", "t", before, after)
        assert "NestedLoop" not in plan_text(got)
        low, high = dt.timedelta(days=before), dt.timedelta(days=after)
        want = sorted((x[2], y[2]) for x in left for y in right
                      if x[0] and x[0] == y[0] and x[1] and x[1] - low <= y[1] <= x[1] + high)
        assert sorted((r.bucket, r.rt) for r in got.collect()) == want


def test_time_split_keeps_names_and_signs(spark):
    data = [(dt.date(2024, 1, 1 + k // 7), float(k % 3), -0.0 if k % 2 else 0.0, k % 2) for k in range(20)]
    df = spark.createDataFrame(data, "t date, col double, _c double, _n int")
    train, test = ranking.time_split(df, "t", 0.5)
    assert train.columns == test.columns == df.columns
    assert train.count() == 10 and rows(train.union(test)) == rows(df)
    signs = train.union(test).where(F.col("_c").cast("string") == "-0.0")
    assert signs.count() == 10 and {r["_n"] for r in signs.collect()} == {1}


def test_hot_time_is_not_exchanged_by_the_bare_time(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("TIMESTAMP"),
                                   (F.col("id") * 7 % 900).cast("double").alias("v"))
    fast = ranking.add_pct_rank(df, "v", skew_safe=True)
    assert rows(fast) == rows(ranking.add_pct_rank(df, "v"))
    exchanges = [x for x in plan_text(fast).split("\n") if "hashpartitioning(TIMESTAMP" in x]
    assert all(x.count("#") > 1 for x in exchanges)
