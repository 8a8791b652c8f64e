"""Per-ticker window features (W1-W3, W5, W6) and the top-n / history reads.

Row order is never implicit: every window orders by the time column (nulls
last) and then by explicit tie-breaker columns. All features on the same
(group, order) share one Exchange + Sort in the physical plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortbook.names import col as qcol, cols as qcols

from shortbook.operators.segmented import resolve_skew_safe, segmented_window
from shortbook.schemas import DEFAULT_MIN_PCT_CHANGE, DEFAULT_ZSCORE_WINDOW, SYMBOL_COL


def order_cols(time_col: str, tie_breakers: Sequence[str]) -> list[Column]:
    return [qcol(time_col).asc_nulls_last()] + [qcol(c).asc_nulls_last() for c in tie_breakers]


def _keys_present(group_cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in group_cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _per_ticker(expr: Column, group_cols: Sequence[str]) -> Column:
    """Null group keys give null features (pandas groupby drops null keys)."""
    return F.when(_keys_present(group_cols), expr)


def _with_window(df, group_cols, time_col, tie_breakers, build, lookback=0, lookahead=0, skew_safe=False):
    """Add ``build(w)`` columns over the per-group ordered window ``w``.

    ``skew_safe=True`` runs through ``segmented_window`` so no group is ever
    confined to one task; ``False`` is a plain window (one hash shuffle on
    the group). ``"auto"`` (default) measures group sizes first and takes
    the segmented path only when a group is hot."""
    order = order_cols(time_col, tie_breakers)
    if resolve_skew_safe(skew_safe, df, group_cols):
        return segmented_window(df, list(group_cols), order, build, lookback, lookahead)
    exprs = build(Window.partitionBy(*qcols(group_cols)).orderBy(*order))
    return df.select("*", *[e.alias(k) for k, e in exprs.items()])


def _shifted(col, periods, w):
    return F.lag(col, periods).over(w) if periods >= 0 else F.lead(col, -periods).over(w)


def _reach(periods):
    return (periods, 0) if periods >= 0 else (0, -periods)


class Feature:
    """One per-ticker feature: output name, expression over a window, and
    how many rows back / ahead its frame reaches."""

    def __init__(self, name, build, lookback=0, lookahead=0):
        self.name, self.build, self.lookback, self.lookahead = name, build, lookback, lookahead


def lag_feature(col, periods=1, output=None, group_cols=(SYMBOL_COL,)) -> Feature:
    back, ahead = _reach(periods)
    return Feature(output or f"{col}_lag{periods}",
                   lambda w: _per_ticker(_shifted(col, periods, w), group_cols), back, ahead)


def diff_feature(col, periods=1, output=None, group_cols=(SYMBOL_COL,)) -> Feature:
    back, ahead = _reach(periods)
    return Feature(output or f"{col}_diff{periods}",
                   lambda w: _per_ticker(F.col(col) - _shifted(col, periods, w), group_cols), back, ahead)


def log_ratio(x: Column, p: Column, finite_only: bool = False) -> Column:
    """ln(x / p) with numpy's edge results, safe under ANSI (no x/0 evaluated).

    p=0,x>0 -> +inf; x=0,p!=0 -> -inf; 0/0, negative ratio, nulls -> null.
    """
    pos_inf = F.lit(float("inf"))
    neg_inf = F.lit(float("-inf"))
    e = (
        F.when(x.isNull() | p.isNull(), F.lit(None).cast("double"))
        .when((p == 0) & (x > 0), F.lit(None).cast("double") if finite_only else pos_inf)
        .when(p == 0, F.lit(None).cast("double"))
        .when(x == 0, F.lit(None).cast("double") if finite_only else neg_inf)
        .when((x / p) < 0, F.lit(None).cast("double"))
        .otherwise(F.ln(x / p))
    )
    return e


def log_return_feature(col="FEERATE", output="log_return", group_cols=(SYMBOL_COL,), finite_only=False) -> Feature:
    return Feature(output, lambda w: _per_ticker(log_ratio(F.col(col), F.lag(col, 1).over(w), finite_only),
                                                  group_cols), 1, 0)


def z_score_feature(col, window=DEFAULT_ZSCORE_WINDOW, output=None, group_cols=(SYMBOL_COL,)) -> Feature:
    def build(w):
        f = w.rowsBetween(-(window - 1), 0)
        n, mean, sd = F.count(col).over(f), F.avg(col).over(f), F.stddev_samp(col).over(f)
        return _per_ticker(F.when((n == window) & (sd != 0), (F.col(col) - mean) / sd), group_cols)
    return Feature(output or f"{col}_zscore", build, window - 1, 0)


def add_ticker_features(df, feats, group_cols=(SYMBOL_COL,), time_col="TIMESTAMP", tie_breakers=(),
                        skew_safe=False):
    """Several per-ticker features in one window pass (one shuffle)."""
    feats = list(feats)
    if not feats:
        return df
    return _with_window(
        df, group_cols, time_col, tie_breakers, lambda w: {f.name: f.build(w) for f in feats},
        max(f.lookback for f in feats), max(f.lookahead for f in feats), skew_safe)


def add_lag(df, col, periods=1, output=None, group_cols=(SYMBOL_COL,), time_col="TIMESTAMP", tie_breakers=(),
            skew_safe=False):
    """Value ``periods`` rows earlier in the ticker (negative = later)."""
    return add_ticker_features(df, [lag_feature(col, periods, output, group_cols)], group_cols, time_col,
                               tie_breakers, skew_safe)


def add_diff(df, col, periods=1, output=None, group_cols=(SYMBOL_COL,), time_col="TIMESTAMP", tie_breakers=(),
             skew_safe=False):
    """``col - lag(col, periods)`` within the ticker."""
    return add_ticker_features(df, [diff_feature(col, periods, output, group_cols)], group_cols, time_col,
                               tie_breakers, skew_safe)


def add_log_returns(
    df, col="FEERATE", output="log_return", group_cols=(SYMBOL_COL,), time_col="TIMESTAMP",
    tie_breakers=(), finite_only=False, skew_safe=False,
):
    """ln(x / previous x) per ticker."""
    return add_ticker_features(df, [log_return_feature(col, output, group_cols, finite_only)], group_cols,
                               time_col, tie_breakers, skew_safe)


def add_z_score(
    df, col, window=DEFAULT_ZSCORE_WINDOW, output=None, group_cols=(SYMBOL_COL,), time_col="TIMESTAMP",
    tie_breakers=(), skew_safe=False,
):
    """Rolling z-score over the last ``window`` rows of the ticker.

    Needs a full window of non-null values; sample stddev; stddev 0 -> null.
    """
    return add_ticker_features(df, [z_score_feature(col, window, output, group_cols)], group_cols, time_col,
                               tie_breakers, skew_safe)


def availability_changes(
    df: DataFrame,
    min_pct_change: float = DEFAULT_MIN_PCT_CHANGE,
    group_cols: Sequence[str] = (SYMBOL_COL,),
    time_col: str = "TIMESTAMP",
    tie_breakers: Sequence[str] = (),
    value_col: str = "AVAILABLE",
    skew_safe: bool | str = False,
) -> DataFrame:
    """Rows whose availability moved by at least ``min_pct_change`` percent
    against the previous row of the ticker (SQL semantics: null SYM is a group).
    The threshold compares the unrounded change; output is rounded to 2 dp."""
    ranked = _with_window(df, group_cols, time_col, tie_breakers,
                          lambda w: {"prev_avail": F.lag(value_col, 1).over(w)}, 1, 0, skew_safe)
    p = F.col("prev_avail")
    raw = F.lit(100.0) * (F.col(value_col) - p) / F.when(p != 0, p)
    return (
        ranked.where(p.isNotNull() & (F.abs(raw) >= F.lit(float(min_pct_change))))
        .select(
            *[F.col(c) for c in group_cols if c != SYMBOL_COL],
            SYMBOL_COL, "NAME", time_col, "prev_avail", F.col(value_col).alias("AVAILABLE"),
            F.round(raw, 2).alias("pct_change"),
        )
        # secondary keys give the range partitioner distinct values to split
        # on when one change size (e.g. -100 %) is very common
        .orderBy(F.abs(F.col("pct_change")).desc_nulls_last(),
                 *[qcol(c).asc_nulls_last() for c in (*group_cols, time_col)])
    )


def top_short_borrow(
    df: DataFrame, n: int = 50, tie_breakers: Sequence[str] = (SYMBOL_COL, "CON")
) -> DataFrame:
    """Highest fee rate among borrowable rows (AVAILABLE > 0).

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task cross the network.
    """
    ties = [F.col(c).asc_nulls_last() for c in tie_breakers if c in df.columns]
    return (
        df.where(F.col("AVAILABLE") > 0)
        .orderBy(F.col("FEERATE").desc_nulls_last(), *ties)
        .limit(n)
        .select("SYM", "NAME", "FEERATE", "REBATERATE", "AVAILABLE", "CURRENCY", "COUNTRY")
    )


def ticker_history(
    df: DataFrame, symbol: str, normalized: bool = False, time_col: str = "TIMESTAMP",
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Every row of one ticker, oldest first, case-insensitive.

    With ``normalized`` (the caller knows that symbols are stored upper-case)
    the predicate is a plain equality that reaches the Parquet scan.
    """
    target = F.lit(symbol).cast("string")
    pred = (F.col(SYMBOL_COL) == F.upper(target)) if normalized else (F.upper(F.col(SYMBOL_COL)) == F.upper(target))
    return df.where(pred).orderBy(*order_cols(time_col, tie_breakers))
