"""Physical-plan assertions (the shapes we rely on at scale)."""

from pyspark.sql import functions as F

from conftest import plan_text
from shortbook.operators import changes, features, joins
from shortbook.plans import registry, views


def test_plain_chained_ticker_features_share_one_exchange(spark, sf):
    df = views.stock_loan(spark, sf)
    for fn in (
        lambda d: features.add_log_returns(d, "FEERATE", tie_breakers=["SEQ"], skew_safe=False),
        lambda d: features.add_z_score(d, "FEERATE", 20, tie_breakers=["SEQ"], skew_safe=False),
        lambda d: features.add_lag(d, "AVAILABLE", 1, tie_breakers=["SEQ"], skew_safe=False),
        lambda d: features.add_diff(d, "AVAILABLE", 1, tie_breakers=["SEQ"], skew_safe=False),
    ):
        df = fn(df)
    text = plan_text(df)
    assert text.count("Exchange (") == 1
    assert "SinglePartition" not in text


def test_batched_skew_safe_features_one_window_shuffle(spark, sf):
    import re
    feats = [features.z_score_feature("FEERATE", 20), features.lag_feature("AVAILABLE", 1),
             features.diff_feature("FEERATE", 3)]
    df = features.add_ticker_features(views.stock_loan_nulls(spark, sf), feats, tie_breakers=["SEQ"],
                                      skew_safe=True)
    text = plan_text(df)
    assert len(re.findall(r"hashpartitioning\(_pid#\d+, SYM#\d+", text)) == 1
    assert "rangepartitioning" not in text  # frozen by the checkpoint


def test_dataset_ticker_filter_goes_below_pending_features(spark, sf, tmp_path):
    from shortbook.plans.dataset import TradingDataset
    from shortbook.sources.catalog import Catalog
    path = str(tmp_path / "sl2")
    views.stock_loan(spark, sf).write.parquet(path)
    ds = TradingDataset(spark, Catalog(spark, {"stock_loan": path}), tie_breakers=["SEQ"]).load()
    ds = ds.add_lag("AVAILABLE", 1).filter_tickers(["u1"])
    assert ds.df.count() == views.stock_loan(spark, sf).where("SYM = 'U1'").count()


def test_top_n_is_take_ordered(spark, sf):
    assert "TakeOrderedAndProject" in plan_text(registry.QUERIES["top_short_borrow"](spark, sf))


def test_keep_last_dedupe_is_partial_aggregate(spark, sf):
    text = plan_text(registry.QUERIES["dedupe_keep_last"](spark, sf))
    assert "partial_max_by" in text
    assert "Window" not in text


def test_change_tracking_has_no_cartesian(spark, sf):
    for key in ("change_timestamps", "change_history"):
        text = plan_text(registry.QUERIES[key](spark, sf))
        assert "CartesianProduct" not in text
        assert "NestedLoopJoin" not in text


def test_ticker_filter_after_window_reaches_scan(spark, sf, tmp_path):
    path = str(tmp_path / "sl")
    views.stock_loan(spark, sf).write.parquet(path)
    df = features.add_z_score(spark.read.parquet(path), "FEERATE", 20, tie_breakers=["SEQ"], skew_safe=False)
    text = plan_text(df.where(F.col("SYM") == "U1"))
    assert "EqualTo(SYM,U1)" in text


def test_projection_is_pruned_at_scan(spark, sf):
    text = plan_text(registry.QUERIES["sql_params"](spark, sf))
    scan = text.split("ReadSchema:")[1].splitlines()[0]
    assert "value" in scan and "user_id" in scan and "event_type" in scan
    assert "event_id" not in scan and "ts:" not in scan
    assert "PushedFilters" in text


def test_cik_lookup_broadcasts_checked_map(spark, sf):
    text = plan_text(registry.QUERIES["filings_enriched"](spark, sf))
    assert "BroadcastHashJoin" in text


def test_asof_join_is_one_window_no_theta_join(spark, sf):
    text = plan_text(registry.QUERIES["asof_join"](spark, sf))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "Window" in text


def test_global_pct_rank_has_no_single_partition_window_on_rows(spark, sf):
    # the only single-partition window is over one row per range partition
    from shortbook.operators import ranking
    df = views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    text = plan_text(ranking.add_pct_rank(df, "o_totalprice", by=None))
    assert "RangePartitioning" in text or "LogicalRDD" in text or "ExistingRDD" in text


def test_auto_mode_picks_segmented_only_for_hot_groups(spark):
    from shortbook.operators.segmented import has_hot_group
    even = spark.range(4000).selectExpr("cast(id % 200 as string) as SYM")
    hot = spark.range(4000).selectExpr("case when id % 3 = 0 then cast(id as string) else 'HOT' end as SYM")
    assert not has_hot_group(even, ["SYM"])
    assert has_hot_group(hot, ["SYM"])


def test_latest_week_prunes_partitions_dynamically(spark, sf, tmp_path):
    from shortbook.functions import calendar
    from shortbook.plans import jobs
    p = str(tmp_path / "ats")
    views.ats_otc(spark, sf).write.partitionBy("initialPublishedDate").parquet(p)
    ats = spark.read.parquet(p).withColumn("initialPublishedDate", F.col("initialPublishedDate").cast("string"))
    li = views.table(spark, sf, "lineitem")
    b = li.agg(calendar.this_monday(F.min("l_shipdate")).alias("start"),
               calendar.this_monday(F.max("l_shipdate")).alias("end"))
    text = plan_text(jobs.otc_latest_week(ats, b))
    assert "dynamicpruning" in text


def test_ticker_in_filter_after_window_reaches_scan(spark, sf, tmp_path):
    path = str(tmp_path / "sl3")
    views.stock_loan(spark, sf).write.parquet(path)
    df = features.add_lag(spark.read.parquet(path), "AVAILABLE", 1, tie_breakers=["SEQ"], skew_safe=False)
    text = plan_text(df.where(F.col("SYM").isin("U1", "U2")))
    assert "In(SYM, [U1,U2])" in text


def test_no_forced_size_checks(spark, sf):
    """Joins carry no hints from counting the input; Catalyst sees the sizes."""
    import datetime as dt
    from shortbook.functions import calendar
    b = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "start date, end date")
    cal = calendar.mondays(b)
    text = plan_text(calendar.first_business_days(cal, calendar.holiday_table(cal)))
    assert "CollectLimit" not in text and "CartesianProduct" not in text

