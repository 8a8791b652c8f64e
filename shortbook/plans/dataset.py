"""Model-ready datasets (M1-M5): load, features, splits, matrix export.

An immutable wrapper over one lazy DataFrame (P14: using it before a load
raises; ``len`` counts; ``repr`` shows the sources); each ``add_*`` returns
a new dataset. Feature windows on the same ticker order share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shortbook.operators import features, ranking, relational
from shortbook.plans.engine import QueryEngine
from shortbook.sources.catalog import Catalog


class TradingDataset:
    def __init__(
        self,
        spark: SparkSession,
        catalog: Catalog,
        sources: Sequence[str] | None = None,
        df: DataFrame | None = None,
        tie_breakers: Sequence[str] = (),
        pending: tuple = (),
        skew_safe: bool | str = False,
    ):
        self.spark = spark
        self.catalog = catalog
        self.engine = QueryEngine(spark, catalog)
        self.sources = list(sources or ["stock_loan"])
        self._df = df
        self.tie_breakers = tuple(tie_breakers)
        # consecutive per-ticker features on the same ticker order are
        # computed together in one window pass when the frame is needed
        self._pending = tuple(pending)
        self.skew_safe = skew_safe

    def _with(self, df: DataFrame, pending: tuple = ()) -> "TradingDataset":
        return TradingDataset(self.spark, self.catalog, self.sources, df, self.tie_breakers, pending,
                              self.skew_safe)

    def _add(self, feat, group_cols, tie_breakers) -> "TradingDataset":
        if self._df is None:
            raise RuntimeError("no data yet: load() or load_sql() comes before features")
        key = (tuple(group_cols), tuple(tie_breakers) if tie_breakers is not None else self.tie_breakers)
        if self._pending and self._pending[0][0] != key:
            return self._with(self.df)._add(feat, group_cols, tie_breakers)
        return self._with(self._df, self._pending + ((key, feat),))

    @property
    def df(self) -> DataFrame:
        if self._df is None:
            raise RuntimeError("no data yet: load() or load_sql() comes before features")
        if not self._pending:
            return self._df
        (group_cols, ties), _ = self._pending[0]
        return features.add_ticker_features(
            self._df, [f for _, f in self._pending], group_cols, "TIMESTAMP", ties, self.skew_safe)

    # M1: per-source query (limit applies per source), tagged, union by name.
    def load(self, where: str = "", columns: str = "*", limit: int = 0) -> "TradingDataset":
        frames = [
            relational.with_source(
                self.engine.query_source(src, columns=columns, where=where, limit=limit), src
            )
            for src in self.sources
        ]
        return self._with(relational.union_by_name(frames))

    # M2
    def load_sql(self, query: str, params: Sequence | None = None) -> "TradingDataset":
        self.engine.register_sources(self.sources)
        return self._with(self.engine.sql(query, params))

    def add_log_returns(self, col="FEERATE", output="log_return", group_cols=("SYM",), tie_breakers=None,
                        finite_only=False):
        return self._add(features.log_return_feature(col, output, group_cols, finite_only), group_cols, tie_breakers)

    def add_z_score(self, col, window=20, output=None, group_cols=("SYM",), tie_breakers=None):
        return self._add(features.z_score_feature(col, window, output, group_cols), group_cols, tie_breakers)

    def add_pct_rank(self, col, output=None):
        return self._with(ranking.add_pct_rank(self.df, col, output, by="TIMESTAMP"))

    def add_lag(self, col, periods=1, output=None, group_cols=("SYM",), tie_breakers=None):
        return self._add(features.lag_feature(col, periods, output, group_cols), group_cols, tie_breakers)

    def add_diff(self, col, periods=1, output=None, group_cols=("SYM",), tie_breakers=None):
        return self._add(features.diff_feature(col, periods, output, group_cols), group_cols, tie_breakers)

    # P7, P8
    def filter_tickers(self, tickers: Sequence[str]) -> "TradingDataset":
        """Keeps whole tickers, so pending per-ticker features (grouped by
        SYM) give the same values when the filter runs first -- it does, and
        reaches the scan instead of following the shuffle."""
        if self._pending and "SYM" in self._pending[0][0][0]:
            return self._with(relational.filter_tickers(self._df, tickers), self._pending)
        return self._with(relational.filter_tickers(self.df, tickers))

    def dropna(self, subset: Sequence[str] | None = None) -> "TradingDataset":
        return self._with(relational.dropna(self.df, subset))

    # M4 / W9, M5 / J6
    def time_split(self, time_col="TIMESTAMP", train_frac=0.8, tie_breakers=None):
        ties = tuple(tie_breakers) if tie_breakers is not None else self.tie_breakers
        return ranking.time_split(self.df, time_col, train_frac, ties)

    def ticker_split(self, test_tickers: Sequence[str]):
        return relational.ticker_split(self.df, test_tickers)

    # M3 (+ to_pandas for small results only)
    def to_matrix(self, feature_cols=None, target_col=None, keep=()) -> DataFrame:
        return relational.feature_matrix(self.df, feature_cols, target_col, keep)

    def write_matrix(self, path: str, feature_cols=None, target_col=None, keep=()) -> str:
        self.to_matrix(feature_cols, target_col, keep).write.mode("overwrite").parquet(path)
        return path

    def _bounded(self, max_rows: int | None) -> DataFrame:
        """The rows, or an error if an asked-for bound is passed (one count)."""
        if max_rows is not None and (n := self.df.count()) > max_rows:
            raise ValueError(f"{n} rows, more than the {max_rows} asked for: write_matrix() makes Parquet shards")
        return self.df

    def to_pandas(self, max_rows: int | None = None):
        """All rows on the driver; with ``max_rows`` larger results are refused."""
        return self._bounded(max_rows).toPandas()

    def to_numpy(self, feature_cols=None, target_col=None, max_rows: int | None = None):
        """(X float32, y float32 or None) on the driver (Arrow transfer); with
        ``max_rows`` larger results are refused."""
        import numpy as np
        self._bounded(max_rows)
        tbl = self.to_matrix(feature_cols, target_col).toArrow()
        feats = tbl.column("features").to_pylist()
        x = np.asarray(feats, dtype=np.float32).reshape(len(feats), -1)
        y = np.asarray(tbl.column("label").to_pylist(), dtype=np.float32) if target_col else None
        return x, y

    def __len__(self) -> int:
        return self.df.count() if self._df is not None else 0

    def __repr__(self) -> str:
        state = "loaded" if self._df is not None else "empty"
        return f"TradingDataset(sources={self.sources}, {state})"
