"""Distributed ordered prefix sums, percentile rank (W4) and time split.

No single-partition window over raw data: values are pre-aggregated, range
partitioned, numbered per partition, and stitched together with one row per
partition of offsets (bounded by the partition count, so it is safe to
broadcast). A hot group is split across many range partitions instead of
landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortbook.names import col as qcol, cols as qcols

from shortbook.session import ensure_checkpoint_dir


def _num_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    weight_col: str,
    group_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``_before`` = sum of ``weight_col`` over rows of the same group that
    sort strictly before each row, and ``_group_total`` = the group's sum.

    ``order`` must be a total order within the group (rows unique on it) and
    start with the group columns when ``group_cols`` is given. Weights >= 0.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if num_partitions is None:
        from shortbook.operators.segmented import _num_partitions as sized
        # the (aggregated) input is materialised once; its size picks the
        # number of range partitions without recomputing the aggregate
        df = df.checkpoint(eager=True)
        num_partitions = sized(df, df.count())
    n = num_partitions
    ranged = (
        df.repartitionByRange(n, *order)
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    # Running sum inside each range partition (partitions are balanced by
    # the range sampler, so this window's groups are bounded in size).
    local_w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(weight_col).over(local_w), F.lit(0)))
    # One row per partition -> offsets of every partition.
    per_pid = ranged.groupBy("_pid").agg(F.sum(weight_col).alias("_pid_total"))
    off_w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_pid.select(
        "_pid",
        F.coalesce(F.sum("_pid_total").over(off_w), F.lit(0)).alias("_pid_off"),
        F.sum("_pid_total").over(Window.partitionBy()).alias("_all_total"),
    )
    glob = local.join(F.broadcast(offsets), "_pid").withColumn("_global", F.col("_pid_off") + F.col("_local"))
    if not group_cols:
        return glob.select(
            *[c for c in df.columns],
            F.col("_global").alias("_before"),
            F.col("_all_total").alias("_group_total"),
        )
    # Only the first and the last group of a partition can go on in another one:
    # their starts and sums are put together from one or two rows a partition.
    # All others lie in one partition, and a window there sees them whole.
    g = [qcol(c) for c in group_cols]
    own = F.struct(*g)
    first_last = ranged.groupBy("_pid").agg(F.min(own).alias("_first"), F.max(own).alias("_last"))
    edge = F.broadcast(first_last.select(
        F.col("_pid").alias("_at"), F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_edge")))
    sums = (glob.withColumn("_own", own)
            .join(edge, (F.col("_pid") == F.col("_at")) & F.col("_own").eqNullSafe(F.col("_edge")))
            .groupBy("_own").agg(F.min("_global").alias("_start"), F.sum(weight_col).alias("_sum")))
    here = Window.partitionBy("_pid", *g)
    out = (glob.withColumn("_own", own)
           .withColumns({"_here": F.min("_global").over(here), "_whole": F.sum(weight_col).over(here)})
           # two groups a partition at most
           .join(F.broadcast(sums.withColumnRenamed("_own", "_of")), F.col("_own").eqNullSafe(F.col("_of")), "left"))
    return out.select(
        *[c for c in df.columns],
        (F.col("_global") - F.coalesce("_start", "_here")).alias("_before"),
        F.coalesce("_sum", "_whole").alias("_group_total"),
    )


def add_pct_rank(
    df: DataFrame,
    col: str,
    output: str | None = None,
    by: str | None = "TIMESTAMP",
    skew_safe: bool | str = False,
) -> DataFrame:
    """Average-tie rank of ``col`` / non-null count, per ``by`` value
    (cross-section at each timestamp) or over the whole table when ``by`` is
    None or absent. Null value or null ``by`` -> null. Not ``percent_rank``.

    Per ``by``: three windows on one exchange unless a ``by`` value is hot
    (``skew_safe="auto"`` measures), then distributed prefix sums. Global:
    always prefix sums (the whole table is one group)."""
    out = output or f"{col}_pctrank"
    grouped = by is not None and by in df.columns
    gcols = [by] if grouped else []
    if grouped:
        from shortbook.operators.segmented import resolve_skew_safe
        if not resolve_skew_safe(skew_safe, df.where(F.col(by).isNotNull()), gcols):
            b, v = qcol(by), qcol(col)
            present = v.isNotNull() & b.isNotNull()
            w = Window.partitionBy(b).orderBy(v.asc_nulls_last())
            ties = F.count(F.lit(1)).over(Window.partitionBy(b, v))
            pct = (F.rank().over(w) + (ties - F.lit(1)) / F.lit(2.0)) / F.count(v).over(Window.partitionBy(b))
            return df.withColumn(out, F.when(present, pct))
    present = F.col(col).isNotNull()
    for g in gcols:
        present = present & F.col(g).isNotNull()
    counts = df.where(present).groupBy(*qcols([*gcols, col])).agg(F.count(F.lit(1)).alias("_c"))
    order = [F.col(g).asc() for g in gcols] + [F.col(col).asc()]
    ranked = prefix_sums(counts, order, "_c", gcols)
    pct = ranked.select(
        *gcols, col,
        ((F.col("_before") + (F.col("_c") + F.lit(1)) / F.lit(2.0)) / F.col("_group_total")).alias(out),
    )
    # N:1 join back on (group, value); null keys never match -> null output.
    return df.join(pct, [*gcols, col], "left").select(*qcols(df.columns), qcol(out))


def time_split(
    df: DataFrame,
    time_col: str = "TIMESTAMP",
    train_frac: float = 0.8,
    tie_breakers: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Chronological split -- the first ``int(n * train_frac)`` rows in
    (time nulls last, tie-breakers, all other columns) order are train, the
    rest test. Rows equal in every column are interchangeable; each row is in
    exactly one part.

    The cut is one value, known after counting rows per time: both parts are
    filters on it. Only the rows of the boundary time are ranked."""
    t = qcol(time_col)
    counts = df.groupBy(t.alias("_t")).agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "_tnull", F.col("_t").isNull().cast("int"))
    cum = prefix_sums(counts, [F.col("_tnull").asc(), F.col("_t").asc()], "_c")
    n = cum.agg(F.max("_group_total")).first()[0] or 0
    k = int(n * train_frac)  # float truncation, exactly as a sorted-prefix cut
    if k >= n:
        return df, df.limit(0)
    is_time = dict(df.dtypes)[time_col] == "timestamp"
    at = F.unix_micros("_t") if is_time else F.col("_t")
    cut = cum.where((F.col("_before") <= k) & (F.col("_before") + F.col("_c") > k)).select(
        at.alias("at"), "_before").first()  # one row: the time that holds row k
    need = k - cut["_before"]
    if cut["at"] is None:
        before, equal, after = t.isNotNull(), t.isNull(), F.lit(False)
    else:
        value = F.timestamp_micros(F.lit(cut["at"])) if is_time else F.lit(cut["at"])
        before, equal, after = t < value, t == value, (t > value) | t.isNull()
    if need == 0:
        return df.where(before), df.where(F.coalesce(equal | after, F.lit(True)))
    # the tied rows under names of their own, so that no column of theirs is in the way;
    # grouping makes -0.0 a 0.0, so its sign is kept beside it
    names = [*tie_breakers, *[c for c in df.columns if c not in tie_breakers]]
    at = {c: f"c{i}" for i, c in enumerate(names)}
    signed = [c for c, kind in df.dtypes if kind in ("float", "double")]
    tied = df.where(equal).select(*[qcol(c).alias(at[c]) for c in names],
                                  *[(qcol(c).cast("string") == "-0.0").alias(f"{at[c]}_sign") for c in signed])
    order = [F.col(c).asc_nulls_last() for c in tied.columns]
    ranked = prefix_sums(tied.groupBy(*tied.columns).agg(F.count(F.lit(1)).alias("_c")), order, "_c")
    first = F.least(F.greatest(F.lit(need) - F.col("_before"), F.lit(0)), F.col("_c"))

    def value(c: str) -> Column:
        own = F.col(at[c])
        return F.when(F.col(f"{at[c]}_sign"), -F.abs(own)).otherwise(own) if c in signed else own

    def times(n_rows: Column) -> DataFrame:
        """Each distinct tied row so many times."""
        some = ranked.withColumn("_n", n_rows.cast("int")).where("_n > 0")
        return (some.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
                .select(*[value(c).alias(c) for c in df.columns]))

    return (df.where(before).unionByName(times(first)),
            df.where(after).unionByName(times(F.col("_c") - first)))
