"""Skew-proof ordered windows with a bounded frame.

A window ``PARTITION BY sym ORDER BY t`` puts every row of one symbol in one
task; a symbol holding a third of the data would stall the job. Here the
rows are range-partitioned on (group, order) instead -- the range sampler
splits a hot group over many partitions -- and sorted within partitions.
``monotonically_increasing_id`` then gives each row its partition and its
position inside the partition (deterministic: fixed range bounds, total
sort order). A frame reaching ``lookback`` rows back / ``lookahead`` rows
ahead only needs that many rows of the neighbouring partitions: those
"halo" rows (at most partitions x frame rows, a bound independent of the
data size) are copied into the partition that needs them, the window runs
per (partition, group), and halo rows are dropped. Results are exact.

Cost: one range shuffle written once as a checkpoint (read by the rows,
the per-partition counts and the halos) plus one hash shuffle for the
window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortbook.names import col as qcol, cols as qcols

from shortbook.session import ensure_checkpoint_dir

_SHIFT = 33
_MASK = (1 << _SHIFT) - 1
# Range partitions hold at most about this many rows (never fewer
# partitions than spark.sql.shuffle.partitions).
ROWS_PER_RANGE_PARTITION = 2_000_000


def _num_partitions(df: DataFrame, rows: int | None = None) -> int:
    base = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    if rows is None:
        return base
    return max(base, -(-rows // ROWS_PER_RANGE_PARTITION))


def ranged_rows(df: DataFrame, order: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """Range partition + sort on ``order``; add ``_pid`` and ``_local``.

    The result is checkpointed (reliable, in the cluster's checkpoint
    folder): the range sampler is seeded per RDD, so every consumer of the
    partition ids must read one materialised partitioning, also after an
    executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    n = num_partitions or _num_partitions(df)
    r = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    r = r.withColumn("_mid", mid).withColumn("_pid", F.shiftright("_mid", _SHIFT).cast("int")).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit(_MASK))).drop("_mid")
    return r.checkpoint(eager=True)


def partition_sizes(ranged: DataFrame) -> list[tuple[int, int]]:
    """(partition, rows) of the non-empty partitions in order: one pass over
    the checkpoint, one row a partition on the driver."""
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt")).collect()
    return sorted((int(r["_pid"]), int(r["_cnt"])) for r in counts)


def halo_spans(sizes: Sequence[tuple[int, int]], span: int, before: bool) -> list[tuple[int, int, int, int]]:
    """(source, target, low, high): the places ``low <= place < high`` of a
    source partition that a target partition needs, the last ``span`` rows in
    front of it or the first ``span`` after it. Every entry stands for at least
    one row, so there are at most partitions x span of them, and one a partition
    where partitions are longer than the span."""
    out = []
    step = -1 if before else 1
    for i, (target, _) in enumerate(sizes):
        left, k = span, i + step
        while left > 0 and 0 <= k < len(sizes):
            source, n = sizes[k]
            take = min(left, n)
            out.append((source, target, n - take, n) if before else (source, target, 0, take))
            left, k = left - take, k + step
    return out


def _halo(ranged: DataFrame, sizes: Sequence[tuple[int, int]], cols: Sequence[str], span: int, before: bool) -> DataFrame:
    """The rows other partitions need: an interval of places per pair of
    partitions, so exactly the halo's rows leave the join."""
    spans = F.broadcast(ranged.sparkSession.createDataFrame(  # bounded by the partition count and the span
        halo_spans(sizes, span, before), "_spid int, _tpid int, _low long, _high long"))
    at = (F.col("_pid") == F.col("_spid")) & (F.col("_local") >= F.col("_low")) & (F.col("_local") < F.col("_high"))
    return ranged.join(spans, at).select(*qcols(cols), F.col("_tpid").alias("_pid"), F.lit(True).alias("_halo"))


def segmented_window(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    build: Callable[[Window], dict[str, Column]],
    lookback: int = 0,
    lookahead: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add the columns ``build(w)`` returns, where ``w`` is the window over
    each group ordered by ``order``; every frame used must stay within
    ``lookback`` rows before and ``lookahead`` rows after the current row."""
    cols = list(df.columns)
    range_order = [qcol(g).asc_nulls_last() for g in group_cols] + list(order)
    if num_partitions is None:
        num_partitions = _num_partitions(df, group_stats(df, group_cols)[1])
    ranged = ranged_rows(df, range_order, num_partitions)
    sizes = partition_sizes(ranged)
    rows = ranged.select(*qcols(cols), "_pid", F.lit(False).alias("_halo"))
    if lookback > 0:
        rows = rows.unionByName(_halo(ranged, sizes, cols, lookback, True))
    if lookahead > 0:
        rows = rows.unionByName(_halo(ranged, sizes, cols, lookahead, False))
    w = Window.partitionBy("_pid", *qcols(group_cols)).orderBy(*order)
    exprs = build(w)
    out = rows.select("*", *[e.alias(name) for name, e in exprs.items()])
    return out.where(~F.col("_halo")).select(*qcols(cols), *qcols(exprs.keys()))


# A group is "hot" when it holds more rows than this many average partitions.
HOT_GROUP_FACTOR = 2.0


def group_stats(df: DataFrame, group_cols: Sequence[str]) -> tuple[int, int]:
    """(largest group, total rows) from one pruned, partially aggregated
    pass over the group columns."""
    sizes = df.groupBy(*qcols(group_cols)).agg(F.count(F.lit(1)).alias("_n"))
    row = sizes.agg(F.max("_n").alias("mx"), F.sum("_n").alias("tot")).first()
    return int(row["mx"] or 0), int(row["tot"] or 0)


def has_hot_group(df: DataFrame, group_cols: Sequence[str], num_partitions: int | None = None,
                  factor: float = HOT_GROUP_FACTOR) -> bool:
    """Is the largest group bigger than ``factor`` average partitions?"""
    mx, tot = group_stats(df, group_cols)
    if tot == 0:
        return False
    n = num_partitions or _num_partitions(df, tot)
    return mx * n > factor * tot


def resolve_skew_safe(skew_safe, df: DataFrame, group_cols: Sequence[str]) -> bool:
    """``True`` / ``False`` as given (no job runs); ``"auto"``, on request
    only, measures the groups first."""
    if skew_safe == "auto":
        return has_hot_group(df, group_cols)
    return bool(skew_safe)
