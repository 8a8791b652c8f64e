"""Projection / filter / union basics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortbook.functions.text import NUMBER
from shortbook.names import col as qcol
from shortbook.schemas import SYMBOL_COL

# Lists above this size become a broadcast semi/anti join instead of IN.
_ISIN_MAX = 1000
# A user-supplied ticker list is broadcast only up to this many entries.
_TICKER_LIST_BROADCAST_MAX = 5_000_000


def _ticker_frame(df: DataFrame, tickers: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    upper = sorted({t.upper() for t in tickers})
    frame = spark.createDataFrame([(t,) for t in upper], "_ticker string")
    return F.broadcast(frame) if len(upper) <= _TICKER_LIST_BROADCAST_MAX else frame


def in_tickers(tickers: Sequence[str], col: str = SYMBOL_COL) -> Column:
    """Membership test that is False (never null) for a null symbol."""
    upper = sorted({t.upper() for t in tickers})
    return F.coalesce(qcol(col).isin(upper), F.lit(False))


def filter_tickers(df: DataFrame, tickers: Sequence[str], col: str = SYMBOL_COL) -> DataFrame:
    """Keep rows whose symbol is in the (upper-cased) list; data is not
    case-folded. Short lists push down as IN; long lists use a semi join."""
    if len(tickers) <= _ISIN_MAX:
        return df.where(in_tickers(tickers, col))
    t = _ticker_frame(df, tickers)
    return df.join(t, qcol(col) == t["_ticker"], "left_semi")


def ticker_split(
    df: DataFrame, test_tickers: Sequence[str], col: str = SYMBOL_COL
) -> tuple[DataFrame, DataFrame]:
    """(train, test); null symbols go to train."""
    if len(test_tickers) <= _ISIN_MAX:
        mask = in_tickers(test_tickers, col)
        return df.where(~mask), df.where(mask)
    t = _ticker_frame(df, test_tickers)
    cond = qcol(col) == t["_ticker"]
    return df.join(t, cond, "left_anti"), df.join(t, cond, "left_semi")


def dropna(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in ``subset`` (default: all columns).
    Names are quoted, so headers with dots resolve as written."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in subset] if subset else None
    return df.dropna(how="any", subset=quoted)


def normalise_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Strip, upper-case, spaces -> '_', then apply ``renames``."""
    names = [c.strip().upper().replace(" ", "_") for c in df.columns]
    names = [(renames or {}).get(n, n) for n in names]
    dupes = {n for n in names if names.count(n) > 1}
    if dupes:
        raise ValueError(f"column names collide after normalising: {sorted(dupes)}")
    return df.toDF(*names)


def coerce_types(df: DataFrame, types: Mapping[str, T.DataType], timestamp_col: str | None = None) -> DataFrame:
    """P10: per-value ``try_cast`` for the declared columns that are present;
    bad values become null instead of failing the job."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in types and f.dataType != types[f.name]:
            text = isinstance(f.dataType, T.StringType) and isinstance(types[f.name], (T.DoubleType, T.FloatType))
            guarded = F.when(c.rlike(NUMBER), F.trim(c)) if text else c
            c = guarded.try_cast(types[f.name])
        if timestamp_col and f.name == timestamp_col and not isinstance(
            f.dataType, (T.TimestampType, T.TimestampNTZType)
        ):
            c = F.expr(f"try_to_timestamp(`{f.name}`)")
        out.append(c.alias(f.name))
    return df.select(*out)


def with_source(df: DataFrame, name: str, col: str = "_source") -> DataFrame:
    """Tag rows with their source name."""
    return df.withColumn(col, F.lit(name))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def move_after(df: DataFrame, col: str, after: str) -> DataFrame:
    """Place ``col`` right after ``after`` (no-op if either is absent)."""
    cols = list(df.columns)
    if col not in cols or after not in cols:
        return df
    cols.remove(col)
    cols.insert(cols.index(after) + 1, col)
    return df.select(*[F.col(f"`{c}`") for c in cols])


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def feature_matrix(
    df: DataFrame,
    feature_cols: Sequence[str] | None = None,
    target_col: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """M3: ``features`` = array<float> of the feature columns (default: every
    numeric non-boolean column except the target; an explicit list is taken
    as is) and ``label`` float when a target is given. Nulls become NaN."""
    if feature_cols is None:
        feature_cols = [
            f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name != target_col
        ]
    feats = F.array(*[F.coalesce(F.col(f"`{c}`").cast("float"), F.lit(float("nan")).cast("float")) for c in feature_cols])
    cols = [qcol(c) for c in keep] + [feats.alias("features")]
    if target_col:
        cols.append(F.coalesce(F.col(f"`{target_col}`").cast("float"), F.lit(float("nan")).cast("float")).alias("label"))
    return df.select(*cols)
