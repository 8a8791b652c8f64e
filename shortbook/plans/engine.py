"""SQL and canned analytics over named sources.

Everything returns a lazy DataFrame; nothing is copied to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortbook.operators import features
from shortbook.schemas import DEFAULT_MIN_PCT_CHANGE, DEFAULT_TOP_N, TIE_BREAKERS
from shortbook.sources.catalog import Catalog


class QueryEngine:
    def __init__(self, spark: SparkSession, catalog: Catalog):
        self.spark = spark
        self.catalog = catalog

    # P5: arbitrary SQL (Spark dialect), positional ``?`` parameters.
    def sql(self, query: str, params: Sequence | None = None) -> DataFrame:
        if params:
            return self.spark.sql(query, args=list(params))
        return self.spark.sql(query)

    # Schema as (col_name, data_type).
    def describe(self, source: str) -> DataFrame:
        df = self.catalog.read(source)
        rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        schema = T.StructType([
            T.StructField("col_name", T.StringType(), False),
            T.StructField("data_type", T.StringType(), False),
        ])
        return self.spark.createDataFrame(rows, schema)

    # First n rows, unordered (as the reference).
    def head(self, source: str, n: int = 10) -> DataFrame:
        return self.catalog.read(source).limit(n)

    # Row count as a one-row frame ``n`` (parquet footers when possible).
    def count(self, source: str) -> DataFrame:
        return self.catalog.read(source).agg(F.count(F.lit(1)).alias("n"))

    # SELECT {columns} FROM src [WHERE ..] [ORDER BY ..] [LIMIT ..];
    # where/order may use columns not selected, so they apply first.
    def query_source(
        self, source: str, columns: str = "*", where: str = "", order_by: str = "", limit: int = 0
    ) -> DataFrame:
        # braces in the caller's text are text, not template fields
        select, where, order_by = (s.replace("{", "{{").replace("}", "}}") for s in (columns, where, order_by))
        q = f"SELECT {select} FROM {{src}}"
        if where:
            q += f" WHERE {where}"
        if order_by:
            q += f" ORDER BY {order_by}"
        if limit:
            q += f" LIMIT {int(limit)}"
        return self.spark.sql(q, src=self.catalog.read(source))

    # P6
    def register_sources(self, sources: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
        return self.catalog.register_sources(sources)

    # T1
    def top_short_borrow(self, n: int = DEFAULT_TOP_N) -> DataFrame:
        return features.top_short_borrow(self.catalog.read("stock_loan"), n)

    # T2
    def ticker_history(self, symbol: str, normalized: bool = False) -> DataFrame:
        df = self.catalog.read("stock_loan")
        ties = [c for c in TIE_BREAKERS if c in df.columns]
        return features.ticker_history(df, symbol, normalized=normalized, tie_breakers=ties)

    # W1
    def availability_changes(self, min_pct_change: float = DEFAULT_MIN_PCT_CHANGE) -> DataFrame:
        df = self.catalog.read("stock_loan")
        ties = [c for c in TIE_BREAKERS if c in df.columns]
        return features.availability_changes(df, min_pct_change, tie_breakers=ties)
