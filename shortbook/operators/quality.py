"""Data-quality checks (Q1-Q4, A5) as DataFrames: one pass, all failures
collected (the original stopped at the first failing file)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortbook.names import col as qcol, cols as qcols

from shortbook.schemas import EPS_FORECAST_MAX, EPS_FORECAST_MIN, MARKET_CAP_MAX, MARKET_CAP_MIN

# field -> (lower, upper), inclusive; nulls are exempt.
DEFAULT_RANGES = {
    "Market Cap": (MARKET_CAP_MIN, MARKET_CAP_MAX),
    "EPS Forecast": (EPS_FORECAST_MIN, EPS_FORECAST_MAX),
}


def _bad(c: Column, lo: float, hi: float) -> Column:
    return c.isNotNull() & ~c.between(lo, hi)


def range_violations(
    df: DataFrame,
    values: Mapping[str, Column],
    ranges: Mapping[str, tuple[float, float]] = DEFAULT_RANGES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Q1: one row per (row, field) whose value lies outside its range."""
    parts = []
    for field, (lo, hi) in ranges.items():
        v = F.col("_v")
        parts.append(
            df.select(*qcols(keep), values[field].alias("_v")).where(_bad(v, lo, hi))
            .select(*qcols(keep), F.lit(field).alias("field"), v.alias("value"))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_by_file(
    df: DataFrame,
    file_col: str,
    values: Mapping[str, Column],
    ranges: Mapping[str, tuple[float, float]] = DEFAULT_RANGES,
) -> DataFrame:
    """Q2 + Q3 + A5: per file, row count, nulls per field (warning only),
    out-of-range counts per field and the pass flag -- one aggregation."""
    # clean each value once, then aggregate plain columns
    df = df.select(qcol(file_col), *[values[f].alias(f"_v{i}") for i, f in enumerate(ranges)])
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    bad_total = F.lit(0)
    null_total = F.lit(0)
    for i, (field, (lo, hi)) in enumerate(ranges.items()):
        key = field.lower().replace(" ", "_")
        v = F.col(f"_v{i}")
        aggs.append(F.count_if(v.isNull()).alias(f"n_null_{key}"))
        aggs.append(F.count_if(_bad(v, lo, hi)).alias(f"n_bad_{key}"))
        bad_total = bad_total + F.col(f"n_bad_{key}")
        null_total = null_total + F.col(f"n_null_{key}")
    g = df.groupBy(qcol(file_col)).agg(*aggs)
    return g.withColumn("has_nulls", null_total > 0).withColumn("passed", bad_total == 0)


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q4: per required column -- present?, non-null count, table rows."""
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(present)]
    a = df.agg(*aggs)
    rows = []
    for c in required:
        if c in present:
            nn = F.col(f"_c{present.index(c)}")
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"),
                                 nn.alias("n_non_null")))
        else:
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("present"),
                                 F.lit(None).cast("long").alias("n_non_null")))
    return a.select(F.explode(F.array(*rows)).alias("r"), F.col("_n").alias("n_rows")).select("r.*", "n_rows")
