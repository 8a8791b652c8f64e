"""Mixing sources to target weights by Pfair scheduling.

Each source's documents stand in a fixed pseudo-random order and are cut into
blocks of equal volume. Weights become whole quotas of a period of ``period``
slots, so that block k of a source with quota a has release time
floor(k * period / a) and deadline ceil((k + 1) * period / a). Earliest
deadline first gives each slot to one released block. All quotas add up to the
period, so the schedule repeats: it is computed for one period and every
document finds its slot by arithmetic. At every slot each source has had its
quota's share within less than one block, as long as its documents last; slots
of exhausted sources stay empty. A quota differs from the target weight, as
every source gets a slot; the README has the figures. More sources than a
period has slots get a longer period, of ``SLOTS_PER_SOURCE`` slots a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shortbook.llm.common import table

PERIOD = 1_000
SLOTS_PER_SOURCE = 10
BLOCK_CHARS = 100_000
# hexadecimal digits of the bucket: 16**3 buckets split each source
BUCKET_DIGITS = 3


def source_key(source: Column) -> Column:
    """A key that is never null: null sources are one source of their own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def quotas(volumes: DataFrame, weights: DataFrame | None = None, period: int = PERIOD) -> DataFrame:
    """(key, quota, period) from (key, volume): every source gets one slot, the
    rest of the period goes out by weight, largest remainders last. ``weights``
    has (source, weight), missing and negative ones count as 0; without it the
    weight is the square root of the volume. One row per source; for more than
    ``period`` sources the period is a multiple of it."""
    if weights is None:
        known = volumes.withColumn("w", F.floor(F.sqrt(F.col("volume").cast("double"))))
    else:
        given = weights.select(source_key(F.col("source")).alias("key"),
                               F.round(F.col("weight") * 1_000_000).cast("long").alias("w")) \
            .groupBy("key").agg(F.max("w").alias("w"))
        known = volumes.join(given, "key", "left")
    everything = Window.partitionBy()
    known = known.select("key", F.greatest(F.coalesce("w", F.lit(0)), F.lit(0)).alias("w")) \
        .withColumn("n", F.count("*").over(everything)) \
        .withColumn("total", F.sum("w").over(everything)) \
        .withColumn("w", F.when(F.col("total") > 0, F.col("w")).otherwise(F.lit(1))) \
        .withColumn("total", F.when(F.col("total") > 0, F.col("total")).otherwise(F.col("n"))) \
        .withColumn("period", F.when(F.col("n") <= period, F.lit(period).cast("long")).otherwise(
            F.expr(f"({SLOTS_PER_SOURCE} * n + {period - 1}) div {period} * {period}"))) \
        .withColumn("free", F.col("period") - F.col("n"))
    whole = known.withColumn("share", F.expr("1 + (free * w) div total")) \
        .withColumn("rest", F.expr("(free * w) % total")) \
        .withColumn("left", F.col("period") - F.sum("share").over(everything))
    by_rest = Window.partitionBy().orderBy(F.desc("rest"), "key")
    return whole.select("key", (F.col("share") + F.when(
        F.row_number().over(by_rest) <= F.col("left"), 1).otherwise(0)).cast("long").alias("quota"), "period")


def period_schedule(quota: DataFrame) -> DataFrame:
    """(key, quota, period, nth, slot): earliest deadline first over one
    period, as one fold over the slots. Sources of equal quota have equal
    windows and take turns, so the state is one number per distinct quota:
    the blocks they have placed. Quotas add up to the period, so there are
    fewer than the root of twice the period."""
    one = quota.agg(F.sort_array(F.collect_list(F.struct("key", "quota"))).alias("s"),
                    F.max("period").alias("period"))
    # g: per distinct quota, where its sources stand in s; bound once
    picked = F.expr("""
      transform(array(transform(array_sort(array_distinct(s.quota)), a -> named_struct(
          'quota', a, 'ats', filter(sequence(0, size(s) - 1), i -> s[i].quota = a)))),
        g -> aggregate(
          sequence(0, cast(period as int) - 1),
          named_struct('next', transform(g, x -> 0L), 'order', cast(array() as array<int>)),
          (state, t) -> transform(
            array(array_min(filter(
              transform(
                transform(g, (x, i) -> named_struct(
                  'k', state.next[i] div size(x.ats), 'quota', x.quota, 'group', i,
                  'at', x.ats[cast(state.next[i] % size(x.ats) as int)])),
                c -> named_struct(
                  'deadline', ((c.k + 1) * period + c.quota - 1) div c.quota, 'at', c.at, 'group', c.group,
                  'release', (c.k * period) div c.quota, 'left', c.quota - c.k)),
              c -> c.left > 0 and c.release <= t))),
            best -> named_struct(
              'next', transform(state.next, (n, i) -> if(i = best.group, n + 1, n)),
              'order', array_append(state.order, best.at)))[0],
          state -> state.order))[0]""")
    return (one.filter(F.size("s") > 0)
            .select("s", "period", F.posexplode(picked).alias("slot", "at"))
            .select(F.expr("s[at].key").alias("key"), F.expr("s[at].quota").alias("quota"), "period", "slot")
            .withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("slot")) - 1))


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
        source_col: str = "source", volume_col: str = "n_chars", period: int = PERIOD,
        block: int = BLOCK_CHARS, into: str = "mix") -> DataFrame:
    """Every row of ``docs`` once, with a struct column ``into`` of its quota,
    block, release, deadline, slot and order within the slot.

    Rows sorted by its slot and place are the mixture. Null sources are one
    source; a null or non-positive volume counts as 1; rows with a null id and
    repeated rows are kept and ordered by (hash of the id, id, volume); an
    empty table gives no rows. Extra columns pass through, except that one
    named as ``into`` is replaced. No source is one task: its order is by a hash,
    whose first digits split it into buckets that are summed separately.
    """
    d = docs.drop(into)
    row = d.select(
        F.struct(*[F.col(f"`{c}`") for c in d.columns]).alias("row"),
        source_key(F.col(f"`{source_col}`")).alias("key"),
        F.col(f"`{id_col}`").alias("id"),
        F.greatest(F.coalesce(F.col(f"`{volume_col}`").cast("long"), F.lit(1)), F.lit(1)).alias("volume"),
        F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("draw"),
    ).withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    buckets = row.groupBy("key", "bucket").agg(F.sum("volume").alias("volume"))
    offsets = buckets.select(
        F.col("key").alias("o_key"), F.col("bucket").alias("o_bucket"),
        F.coalesce(F.sum("volume").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    volumes = buckets.groupBy("key").agg(F.sum("volume").alias("volume"))
    schedule = period_schedule(quotas(volumes, weights, period))
    own = Window.partitionBy("key", "bucket").orderBy("draw", F.asc_nulls_first("id"), "volume")
    placed = (row.withColumn("before", F.coalesce(F.sum("volume").over(
                  own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .join(offsets, (F.col("key") == F.col("o_key")) & (F.col("bucket") == F.col("o_bucket")))
              .withColumn("start", F.col("before") + F.col("offset"))
              .withColumn("block", F.expr(f"start div {block}")))
    # the schedule has `period` rows, or some for each source, whatever the documents
    first = F.broadcast(schedule.filter("nth = 0").select("key", "quota", "period"))
    slots = F.broadcast(schedule.select("key", "nth", F.col("slot").alias("slot_")))
    return (placed.join(first, "key")
            .withColumn("nth", F.expr("block % quota")).join(slots, ["key", "nth"])
            .select("row.*", F.struct(
                F.col("quota"), F.col("block"),
                F.expr("(block * period) div quota").alias("release"),
                F.expr("((block + 1) * period + quota - 1) div quota").alias("deadline"),
                F.expr("(block div quota) * period + slot_").alias("slot"),
                F.col("start").alias("place")).alias(into)))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return mix(docs).select("doc_id", "source", "mix.*")


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k,
         greatest(coalesce(n_chars, 1), 1)::BIGINT AS v, md5(coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents
), placed AS (
  SELECT *, coalesce(sum(v) OVER (PARTITION BY k ORDER BY draw, doc_id NULLS FIRST, v
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM d
), w AS (
  SELECT k, floor(sqrt(sum(v)::DOUBLE))::BIGINT AS w FROM d GROUP BY k
), f AS (
  SELECT k, w, {PERIOD} - count(*) OVER () AS free, (sum(w) OVER ())::BIGINT AS total FROM w
), s AS (
  SELECT k, 1 + (free * w) // total AS share, (free * w) % total AS rest FROM f
), q AS (
  SELECT k, (share + CASE WHEN row_number() OVER (ORDER BY rest DESC, k)
         <= {PERIOD} - sum(share) OVER () THEN 1 ELSE 0 END)::BIGINT AS a FROM s
), edf AS (
  SELECT 0::BIGINT AS t, k, a, 0::BIGINT AS j FROM q
  UNION ALL
  SELECT t + 1, k, a, j + CASE WHEN row_number() OVER (ORDER BY
           CASE WHEN j < a AND (j * {PERIOD}) // a <= t THEN ((j + 1) * {PERIOD} + a - 1) // a
                ELSE 1000000000 END, k) = 1 THEN 1 ELSE 0 END
  FROM edf WHERE t < {PERIOD}
), slots AS (
  SELECT k, j, max(t) AS slot FROM edf WHERE j < a GROUP BY k, j
), b AS (
  SELECT doc_id, source, p.k, a AS quota, place, place // {BLOCK_CHARS} AS block
  FROM placed p JOIN q ON p.k = q.k
)
SELECT doc_id, source, quota, block, (block * {PERIOD}) // quota AS release,
       ((block + 1) * {PERIOD} + quota - 1) // quota AS deadline,
       (block // quota) * {PERIOD} + slot AS slot, place
FROM b JOIN slots s ON b.k = s.k AND b.block % b.quota = s.j
"""
