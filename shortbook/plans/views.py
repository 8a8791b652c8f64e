"""Input views derived from the driver tables (FIXTURES.md part 2).

Each builder reads the base parquet tables under ``sf_dir`` and returns a
DataFrame in the shape of one market-data source. The matching SQL text (run
by the oracle) lives in ``VIEW_SQL`` so each oracle query can inline the view
as a CTE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _first_int(c: str) -> Column:
    return F.regexp_extract(F.col(c), "([0-9]+)", 1).cast("double")


def stock_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("U"), _s("user_id")).alias("SYM"),
        F.lit("USD").alias("CURRENCY"),
        F.concat(F.lit("Name "), _s("user_id")).alias("NAME"),
        _s("event_id").alias("CON"),
        F.lit(None).cast("string").alias("ISIN"),
        (-F.col("value")).alias("REBATERATE"),
        F.col("value").alias("FEERATE"),
        _first_int("props").alias("AVAILABLE"),
        F.upper("event_type").alias("COUNTRY"),
        F.col("ts").alias("TIMESTAMP"),
        F.col("event_id").alias("SEQ"),
    )


def stock_loan_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    sl = stock_loan(spark, sf_dir)
    seq = F.col("SEQ")
    return sl.select(
        F.when(seq % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("SYM")).alias("SYM"),
        F.when(seq % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("FEERATE")).alias("FEERATE"),
        F.when(seq % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("AVAILABLE")).alias("AVAILABLE"),
        "TIMESTAMP",
        "SEQ",
    )


def earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("U"), _s(F.col("o_custkey") % 150)).alias("symbol"),
        F.concat(F.lit("Name "), _s(F.col("o_custkey") % 150)).alias("name"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
        .cast("string")
        .alias("reportDate"),
        F.col("o_orderdate").cast("date").cast("string").alias("fiscalDateEnding"),
        (F.col("o_totalprice") / 100000).alias("estimate"),
        F.lit("USD").alias("currency"),
        F.col("o_orderkey").alias("SEQ"),
    )


def nasdaq_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    market_cap = F.when(k % 50 == 0, F.lit("")).otherwise(
        F.concat(
            F.lit("$"),
            _s(F.floor("o_totalprice").cast("bigint")),
            F.lit(","),
            F.lpad(_s(k % 1000), 3, "0"),
            F.lit(",000"),
        )
    )
    eps = (
        F.when(k % 9 == 0, F.lit("N/A"))
        .when(k % 4 == 0, F.concat(F.lit("($"), _s(k % 30), F.lit(".25)")))
        .otherwise(F.concat(F.lit("$"), _s(k % 70), F.lit(".50")))
    )
    return o.select(
        F.concat(F.lit("Customer "), _s("o_custkey")).alias("company_name"),
        F.concat(F.lit("U"), _s("o_custkey")).alias("symbol"),
        market_cap.alias("market_cap"),
        eps.alias("eps_forecast"),
        F.col("o_orderdate").cast("date").cast("string").alias("report_date"),
        k.alias("SEQ"),
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        _s("o_custkey").alias("cik"),
        F.col("c_name").alias("company"),
        F.concat(F.lit("0000-"), _s(k)).alias("accession_number"),
        F.when(k % 3 == 0, "10-K").when(k % 3 == 1, "10-Q").otherwise("8-K").alias("form"),
        F.col("o_orderdate").cast("date").alias("filing_date"),
    )


def ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    a = c.where(key % 3 != 0).select(
        F.lpad(_s(key), 10, "0").alias("cik_str"),
        F.concat(F.lit("T"), _s(key)).alias("ticker"),
        key.alias("pos"),
    )
    b = c.where(key % 10 == 1).select(
        F.lpad(_s(key), 10, "0").alias("cik_str"),
        F.concat(F.lit("X"), _s(key)).alias("ticker"),
        (key + 1000000).alias("pos"),
    )
    return a.unionByName(b)


def ats_otc(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    week = F.date_trunc("week", F.col("l_shipdate")).cast("date").cast("string")
    return (
        li.select(
            F.concat(F.lit("P"), _s("l_partkey")).alias("issueSymbolIdentifier"),
            week.alias("initialPublishedDate"),
            "l_quantity",
        )
        .groupBy("issueSymbolIdentifier", "initialPublishedDate")
        .agg(
            F.sum("l_quantity").alias("totalWeeklyShareQuantity"),
            F.count(F.lit(1)).cast("double").alias("totalWeeklyTradeCount"),
        )
    )


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        F.concat(F.lit("r"), _s(eid)).alias("run_id"),
        F.col("event_type").alias("source"),
        F.lit("convert_upload").alias("action"),
        F.when(eid % 10 == 0, "failed").otherwise("success").alias("status"),
        F.col("ts").alias("started_at"),
        F.col("user_id").alias("rows_processed"),
        F.lit(1).alias("files_uploaded"),
    )


def dataset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.where(eid % 10 != 0).select(
        F.concat(F.lit("r"), _s(eid)).alias("run_id"),
        F.concat(F.lit("s3://bucket/trading_data/"), F.col("event_type"), F.lit(".parquet")).alias("cloud_uri"),
        F.col("event_type").alias("source"),
        F.col("user_id").alias("row_count"),
        (eid * eid * 137).alias("size_bytes"),
        F.col("ts").alias("uploaded_at"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.upper("event_type").alias("COUNTRY"),
        F.concat(F.lit("U"), _s("user_id")).alias("SYM"),
        F.floor(_first_int("props") / 50).cast("double").alias("AVAILABLE"),
        F.floor(F.col("value") / 250).cast("double").alias("FEERATE"),
        F.lit(None).cast("double").alias("REBATERATE"),
        F.col("ts").cast("date").alias("snapshot_date"),
        F.col("event_id").alias("SEQ"),
    )


BUILDERS = {
    "stock_loan": stock_loan,
    "stock_loan_nulls": stock_loan_nulls,
    "earnings": earnings,
    "nasdaq_earnings": nasdaq_earnings,
    "filings": filings,
    "ticker_map": ticker_map,
    "ats_otc": ats_otc,
    "pipeline_runs": pipeline_runs,
    "dataset_files": dataset_files,
    "snapshots": snapshots,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


# The same views as SQL text (runs unchanged in Spark and DuckDB).
VIEW_SQL = {
    "stock_loan": """select concat('U', cast(user_id as string)) as SYM, 'USD' as CURRENCY, concat('Name ', cast(user_id as string)) as NAME,
 cast(event_id as string) as CON, cast(null as string) as ISIN, -value as REBATERATE, value as FEERATE,
 cast(regexp_extract(props, '([0-9]+)', 1) as double) as AVAILABLE, upper(event_type) as COUNTRY, ts as TIMESTAMP, event_id as SEQ from events""",
    "stock_loan_nulls": """select case when SEQ % 17 = 0 then null else SYM end as SYM, case when SEQ % 7 = 0 then null else FEERATE end as FEERATE,
 case when SEQ % 11 = 0 then null else AVAILABLE end as AVAILABLE, TIMESTAMP, SEQ from stock_loan""",
    "earnings": """select concat('U', cast(o_custkey % 150 as string)) as symbol, concat('Name ', cast(o_custkey % 150 as string)) as name,
 cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as string) as reportDate, cast(cast(o_orderdate as date) as string) as fiscalDateEnding,
 o_totalprice / 100000 as estimate, 'USD' as currency, o_orderkey as SEQ from orders""",
    "nasdaq_earnings": """select concat('Customer ', cast(o_custkey as string)) as company_name, concat('U', cast(o_custkey as string)) as symbol,
 case when o_orderkey % 50 = 0 then '' else concat('$', cast(cast(floor(o_totalprice) as bigint) as string), ',', lpad(cast(o_orderkey % 1000 as string), 3, '0'), ',000') end as market_cap,
 case when o_orderkey % 9 = 0 then 'N/A' when o_orderkey % 4 = 0 then concat('($', cast(o_orderkey % 30 as string), '.25)') else concat('$', cast(o_orderkey % 70 as string), '.50') end as eps_forecast,
 cast(cast(o_orderdate as date) as string) as report_date, o_orderkey as SEQ from orders""",
    "filings": """select cast(o_custkey as string) as cik, c_name as company, concat('0000-', cast(o_orderkey as string)) as accession_number,
 case o_orderkey % 3 when 0 then '10-K' when 1 then '10-Q' else '8-K' end as form, cast(o_orderdate as date) as filing_date from orders join customer on o_custkey = c_custkey""",
    "ticker_map": """select lpad(cast(c_custkey as string), 10, '0') as cik_str, concat('T', cast(c_custkey as string)) as ticker, c_custkey as pos from customer where c_custkey % 3 <> 0
 union all select lpad(cast(c_custkey as string), 10, '0'), concat('X', cast(c_custkey as string)), c_custkey + 1000000 from customer where c_custkey % 10 = 1""",
    "ats_otc": """select concat('P', cast(l_partkey as string)) as issueSymbolIdentifier, sum(l_quantity) as totalWeeklyShareQuantity, cast(count(*) as double) as totalWeeklyTradeCount,
 cast(cast(date_trunc('week', l_shipdate) as date) as string) as initialPublishedDate from lineitem group by 1, 4""",
    "pipeline_runs": """select concat('r', cast(event_id as string)) as run_id, event_type as source, 'convert_upload' as action,
 case when event_id % 10 = 0 then 'failed' else 'success' end as status, ts as started_at, user_id as rows_processed, 1 as files_uploaded from events""",
    "dataset_files": """select concat('r', cast(event_id as string)) as run_id, concat('s3://bucket/trading_data/', event_type, '.parquet') as cloud_uri, event_type as source,
 user_id as row_count, event_id * event_id * 137 as size_bytes, ts as uploaded_at from events where event_id % 10 <> 0""",
    "snapshots": """select * from (select upper(event_type) as COUNTRY, concat('U', cast(user_id as string)) as SYM,
 cast(floor(cast(regexp_extract(props, '([0-9]+)', 1) as double) / 50) as double) as AVAILABLE, cast(floor(value / 250) as double) as FEERATE, cast(null as double) as REBATERATE,
 cast(ts as date) as snapshot_date, event_id as SEQ from events) q""",
}

_DEPENDS = {"stock_loan_nulls": ["stock_loan"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named views (and their inputs)."""
    order: list[str] = []
    for n in names:
        for d in _DEPENDS.get(n, []):
            if d not in order:
                order.append(d)
        if n not in order:
            order.append(n)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
