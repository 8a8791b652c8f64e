"""Lookups, the interval join and the as-of join.

J7 has no theta join and no pairs: left and right rows are tagged, unioned,
and a running ``last(right, ignorenulls)`` per key carries the latest right
row to each left row -- one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortbook.names import col as qcol, cols as qcols

from shortbook.functions.text import zfill

def map_lookup(
    df: DataFrame,
    mapping: DataFrame,
    key_expr,
    map_key: str,
    map_value: str,
    map_order: str,
    out: str,
) -> DataFrame:
    """Left lookup; unmatched -> null; a duplicated map key keeps the
    value with the greatest ``map_order`` (last one wins)."""
    m = mapping.groupBy(map_key).agg(F.max_by(map_value, map_order).alias("_v"))
    m = m.select(F.col(map_key).alias("_k"), "_v")
    j = df.join(m, key_expr == F.col("_k"), "left")
    return j.drop("_k").withColumnRenamed("_v", out)


def add_cik_tickers(df: DataFrame, mapping: DataFrame, cik_col: str = "cik", map_key: str = "cik_str",
                    map_value: str = "ticker", map_order: str = "pos") -> DataFrame:
    """J2 + V1: ticker by zero-filled 10-digit CIK."""
    return map_lookup(df, mapping, zfill(F.col(cik_col).cast("string"), 10), map_key, map_value, map_order, "ticker")


def interval_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
                  before: int, after: int, right_by: Sequence[str] | None = None, right_suffix: str = "_r") -> DataFrame:
    """Every pair of a left and a right row of the same keys whose right
    time is at most ``before`` days earlier and ``after`` days later than the
    left time. Columns of the right side that the left has, too, get a suffix.

    Times fall into buckets as long as the interval; a right row goes to the
    one or two buckets in which left rows may see it, so the join is an
    equi-join on keys and bucket, and a hot key is spread over its buckets. Null
    keys and times match nothing."""
    width = max(1, before + after)
    day = F.lit(86_400_000_000)

    def micros(c: str):
        return F.unix_micros(qcol(c).cast("timestamp"))

    def bucket(t):
        return F.floor(t / (day * width)).cast("long")

    taken = set(left.columns)
    names = {c: f"{c}{right_suffix}" if c in taken else c for c in right.columns}
    r_by = list(right_by or by)
    r = right.select(F.struct(*[qcol(c).alias(names[c]) for c in right.columns]).alias("r"),
                     *[qcol(c).alias(f"k{i}") for i, c in enumerate(r_by)], micros(right_time).alias("rt"))
    r = r.withColumn("bucket", F.explode(F.sequence(bucket(F.col("rt") - after * day), bucket(F.col("rt") + before * day))))
    lt = left.select(F.struct(*qcols(left.columns)).alias("l"),
                     *[qcol(c).alias(f"k{i}") for i, c in enumerate(by)], micros(left_time).alias("lt"))
    lt = lt.withColumn("bucket", bucket(F.col("lt")))
    pairs = lt.join(r, [f"k{i}" for i in range(len(by))] + ["bucket"])
    near = (F.col("rt") >= F.col("lt") - before * day) & (F.col("rt") <= F.col("lt") + after * day)
    return pairs.where(near).select("l.*", "r.*")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    right_cols: Sequence[str],
    right_by: Sequence[str] | None = None,
    skew_safe: bool | str = False,
) -> DataFrame:
    """Each left row gets the latest right row of its key whose time is
    at or before the left time (a right row at an equal time counts).
    Unmatched, null key or null time -> right columns null.

    ``skew_safe`` (``"auto"``: when a key is hot): the tagged union is range-partitioned on
    (key, time, side) so a hot key spans many tasks; each partition receives
    one carried row -- the latest right row of its first key from earlier
    partitions, taken from a one-row-per-partition summary."""
    right_by = list(right_by or by)
    rcols = list(right_cols)
    l = left.select("*", F.col(left_time).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"))
    keyed = F.col(right_time).isNotNull()
    for rb in right_by:
        keyed = keyed & F.col(rb).isNotNull()
    r = right.where(keyed).select(
        *[F.col(rb).alias(b) for rb, b in zip(right_by, by)],
        F.col(right_time).cast("timestamp_ntz").alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(*[F.col(c) for c in rcols]).alias("_r"),
    )
    u = l.unionByName(r, allowMissingColumns=True).withColumn("_c", F.lit(1))
    order = [F.col("_c"), F.col("_t").asc_nulls_first(), F.col("_side")]
    from shortbook.operators.segmented import resolve_skew_safe
    if resolve_skew_safe(skew_safe, u, list(by)):
        u = _with_carry(u, list(by), order)
        part = ["_pid", *by]
    else:
        part = list(by)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = u.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
    got = F.col("_t").isNotNull()
    for b in by:
        got = got & F.col(b).isNotNull()
    return carried.where((F.col("_side") == 1) & (F.col("_c") == 1)).select(
        *qcols(left.columns), *[F.when(got, F.col("_m").getField(c)).alias(c) for c in rcols])


def _with_carry(u: DataFrame, by: list[str], order) -> DataFrame:
    from shortbook.operators.segmented import _num_partitions, ranged_rows

    key = F.struct(*[F.col(b) for b in by])
    # counting reads no column; the ranges grow with the rows
    ranged = ranged_rows(u, [F.col(b).asc_nulls_last() for b in by] + order[1:], _num_partitions(u, u.count()))
    # one row per non-empty partition, from one pass: first key, last key, last right row
    # (rows are sorted by key, so it is the last key's if that has one)
    summ = ranged.groupBy("_pid").agg(
        F.min_by(key, "_local").alias("_first"), F.max_by(key, "_local").alias("_last"),
        F.max_by(F.struct(key.alias("k"), F.col("_r").alias("r")),
                 F.when(F.col("_side") == 0, F.col("_local"))).alias("_right"))
    summ = summ.withColumn("_lr", F.when(F.col("_right.k").eqNullSafe(F.col("_last")), F.col("_right.r"))).drop("_right")
    summ = summ.checkpoint(eager=True)  # read twice below
    w = Window.orderBy("_pid")  # over one row per partition
    run = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    summ = summ.withColumn("_cum", F.last("_lr", ignorenulls=True).over(run))
    summ = summ.withColumn("_prev_last", F.lag("_last").over(w)).withColumn("_prev_cum", F.lag("_cum").over(w))
    carry = summ.where((F.col("_prev_last") == F.col("_first")) & F.col("_prev_cum").isNotNull()).select(
        "_pid", *[F.col(f"_first.{b}").alias(b) for b in by],
        F.lit(0).alias("_c"), F.lit(None).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_side"),
        F.col("_prev_cum").alias("_r"))
    return ranged.drop("_local").unionByName(carry, allowMissingColumns=True)
