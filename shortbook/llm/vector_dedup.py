"""Near-duplicate vectors by int8 tile products.

Each vector, scaled to length one, is stored as int8 components with a scale of
its own and the length r of what rounding lost. The product of two rounded
vectors is off the cosine by r1 + m1 * r2 at most (m1: the first one's rounded
length), so tiles of int8 products show which pairs may reach the threshold,
and only those are computed again in double precision.

Vectors are dealt to blocks by hash; every two blocks meet in one group of rows,
the first block held, the other read as a stream. A group returns, per vector,
its links to the other block and one edge to the first vector it is connected
with there, never the pairs. Equal vectors (by a 64-bit hash) are one node that
counts as often as it occurs. All pairs of tiles are looked at: no bound on angles would rule
out a tile of unrelated vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import _arrow_schema, stored, table
from shortbook.llm.components import components

THRESHOLD = 0.95
# components of a block that is held in a task, and rows of one product of tiles
BLOCK_NUMBERS, TILE_ROWS = 1 << 22, 2_048
# for the rounding of the bounds themselves, far above double precision's
SLACK = 1e-6
# candidates whose vectors are gathered at once
GATHERED = 100_000
NODES = "node long, least_id long, copies long, vec array<{kind}>, q binary, scale float, lost float, size int"


def usable(vec: Column) -> Column:
    """Neither null nor empty, all components finite, not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest component goes first, so that squares
    neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, scale, lost) of unit rows: int8 components, their scale, and the
    length of x - scale * q, rounded up."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    q = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    rest = x - scale[:, None].astype(np.float64) * q
    lost = np.sqrt((rest * rest).sum(axis=1)) + SLACK
    return q, scale, lost.astype(np.float32)


class Block:
    """Vectors of one length in memory: rounded, as they are, and their bounds."""

    def __init__(self, node: np.ndarray, copies: np.ndarray, vec: np.ndarray, q: np.ndarray,
                 scale: np.ndarray, lost: np.ndarray):
        self.node, self.copies, self.vec, self.scale = node, copies, vec, scale.astype(np.float32)
        # whole numbers up to 127: products of up to 1,040 components are exact in single precision
        self.q = q.astype(np.float32 if vec.shape[1] <= 1_040 else np.float64)
        self.lost = lost.astype(np.float64)
        self.length = 1 + self.lost  # of the rounded vector, at most

    def __len__(self) -> int:
        return len(self.node)


def candidates(a: Block, rows: slice, b: Block, cols: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and b whose cosine may reach the threshold."""
    product = a.q[rows] @ b.q[cols].T
    product *= b.scale[cols]
    most = float(b.lost[cols].max())
    least = (threshold - SLACK - a.lost[rows] - a.length[rows] * most) / a.scale[rows]
    least -= np.abs(least) * 1e-6
    i, j = np.nonzero(product >= least.astype(np.float32)[:, None])
    bound = (product[i, j].astype(np.float64) * a.scale[rows][i] + a.lost[rows][i]
             + a.length[rows][i] * b.lost[cols][j])
    close = bound >= threshold - SLACK
    return i[close] + rows.start, j[close] + cols.start


def confirmed(a: Block, i: np.ndarray, b: Block, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which candidate pairs reach the threshold in double precision."""
    if not len(i):
        return np.zeros(0, bool)
    own, at = np.unique(i, return_inverse=True)
    other, to = np.unique(j, return_inverse=True)
    x, y = unit(a.vec[own]), unit(b.vec[other])
    if 4 * len(i) >= len(own) * len(other):
        return (x @ y.T)[at, to] >= threshold
    out = np.empty(len(i), bool)
    for k in range(0, len(i), GATHERED):
        some = slice(k, k + GATHERED)
        out[some] = np.einsum("ij,ij->i", x[at[some]], y[to[some]]) >= threshold
    return out


class Links:
    """Link counts and connected parts of the vectors of two blocks."""

    def __init__(self) -> None:
        self.count = np.zeros(0, np.int64)
        self.part = np.zeros(0, np.int64)

    def grow(self, n: int) -> None:
        self.count = np.concatenate([self.count, np.zeros(n, np.int64)])
        self.part = np.concatenate([self.part, np.arange(len(self.part), len(self.part) + n)])

    def add(self, i: np.ndarray, j: np.ndarray, copies_i: np.ndarray, copies_j: np.ndarray) -> None:
        n = len(self.count)
        self.count += (np.bincount(i, copies_j, n) + np.bincount(j, copies_i, n)).astype(np.int64)
        part = self.part
        while True:  # the larger part's root goes under the smaller one's
            u, v = part[i], part[j]
            apart = u != v
            if not apart.any():
                return
            i, j, u, v = i[apart], j[apart], u[apart], v[apart]
            np.minimum.at(part, np.maximum(u, v), np.minimum(u, v))
            while not np.array_equal(up := part[part], part):
                part = up
            self.part = part


def resolve(first: Block, rest: Iterator[Block], threshold: float) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, other, links) of one group: the pairs within ``first`` if no
    block follows, else those between it and the blocks that follow."""
    links, nodes, held = Links(), [first.node], 0
    links.grow(len(first))
    for b in rest:
        held += 1
        at = len(links.count)
        links.grow(len(b))
        nodes.append(b.node)
        _meet(first, b, at, links, threshold)
    if not held:
        _meet(first, first, 0, links, threshold)
    node = np.concatenate(nodes)
    some = np.flatnonzero(links.count)
    if len(some):
        yield node[some], node[links.part[some]], links.count[some]


def _meet(a: Block, b: Block, at: int, links: Links, threshold: float) -> None:
    for k in range(0, len(a), TILE_ROWS):
        rows = slice(k, min(k + TILE_ROWS, len(a)))
        for m in range(k if a is b else 0, len(b), TILE_ROWS):
            cols = slice(m, min(m + TILE_ROWS, len(b)))
            i, j = candidates(a, rows, b, cols, threshold)
            if a is b:
                once = i < j
                i, j = i[once], j[once]
            real = confirmed(a, i, b, j, threshold)
            i, j = i[real], j[real]
            if len(i):
                links.add(i, j + at, a.copies[i], b.copies[j])


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[tuple, Block]]:
    """((dim, pair, side), block) of the stretches of equal keys in a batch."""
    dim, pair, side = (batch.column(k).to_numpy() for k in range(3))
    edge = np.flatnonzero((np.diff(dim) != 0) | (np.diff(pair) != 0) | (np.diff(side) != 0)) + 1
    for a, b in zip([0, *edge], [*edge, len(dim)], strict=True):
        if a == b:
            continue
        own, d = batch.slice(a, b - a), int(dim[a])
        flat = own.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        q = np.frombuffer(b"".join(own.column(6).to_pylist()), np.int8).reshape(-1, d)
        yield (d, int(pair[a]), int(side[a])), Block(
            own.column(3).to_numpy(), own.column(4).to_numpy(), flat, q,
            own.column(7).to_numpy(), own.column(8).to_numpy())


def _joined(blocks: list[Block]) -> Block:
    if len(blocks) == 1:
        return blocks[0]
    return Block(*(np.concatenate([getattr(b, k) for b in blocks])
                   for k in ("node", "copies", "vec", "q", "scale", "lost")))


def similar_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors of the same length link when their cosine, in double precision, is
    at least ``threshold`` (above 0). Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing. component_id is the
    least id reachable; a null id is one only where there is no other, and
    such a row is kept. Repeated rows are vectors of their own. Other columns
    are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    vec = F.col(vec_col).cast(f"array<{kind}>")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable(vec), vec).alias("vec"))
    # equal vectors meet whatever sign their zeros have
    node = F.xxhash64(F.transform("vec", lambda x: x + F.lit(0.0).cast(kind)))
    own = own.withColumn("node", F.when(F.col("vec").isNotNull(), node))
    nodes = _quantised(own.filter("vec is not null").groupBy("node")
                       .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"),
                            F.first("vec").alias("vec")), kind)
    nodes = stored(nodes, "vectors")
    found = stored(_tiles(spark, nodes, kind, threshold), "tile-links")
    parts = components(found.filter("node != other").select(F.col("node").alias("u"), F.col("other").alias("v")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    info = nodes.select("node", "least_id", "copies").join(counts, "node", "left").join(parts, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = info.groupBy("component").agg(F.min("least_id").alias("component_id"))
    info = info.join(least, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    return own.select("vec_id", "node").join(info, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"),
                   F.coalesce("component_id", "vec_id").isNull()).alias("kept"))


def _quantised(nodes: DataFrame, kind: str) -> DataFrame:
    schema_text = NODES.format(kind=kind)
    schema = _arrow_schema(nodes.sparkSession, schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.diff(b.column(3).offsets.to_numpy())
            for d in np.unique(size):
                some = pa.array(np.flatnonzero(size == d))
                own = b.take(some)
                q, scale, lost = quantise(unit(own.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(k).cast(schema.field(k).type) for k in range(4)),
                     pa.array([r.tobytes() for r in q]), pa.array(scale), pa.array(lost),
                     pa.array(np.full(len(some), d, np.int32))], schema=schema)

    return nodes.select("node", "least_id", "copies", "vec").mapInArrow(run, schema_text)


def _tiles(spark: SparkSession, nodes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(node, other, links): per group of two blocks, every vector with links
    there, how many, and the first vector that it is connected with there."""
    n, most = nodes.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(1))).first()
    cores = spark.sparkContext.defaultParallelism
    # blocks that fit a task, and pairs of blocks for three turns of all cores
    blocks = max(1, math.ceil(n * most / BLOCK_NUMBERS),
                 min(math.ceil(math.sqrt(6 * cores)), math.ceil(n / TILE_ROWS)))
    pairs = blocks * (blocks + 1) // 2
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    dealt = (nodes.withColumn("block", F.pmod("node", F.lit(blocks)).cast("int")).withColumn("other", other)
             .select(F.col("size").alias("dim"), (high * (high + 1) / 2 + low).cast("long").alias("pair"),
                     F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
                     "node", "copies", "vec", "q", "scale", "lost"))
    schema_text = "node long, other long, links long"
    schema = _arrow_schema(spark, schema_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for b in batches if b.num_rows for x in _blocks(b))
        ahead = next(rows, None)
        while ahead is not None:
            group, first = ahead[0][:2], []
            while ahead is not None and ahead[0] == (*group, 0):
                first.append(ahead[1])
                ahead = next(rows, None)

            def rest() -> Iterator[Block]:
                nonlocal ahead
                while ahead is not None and ahead[0][:2] == group:
                    yield ahead[1]
                    ahead = next(rows, None)

            if not first:  # no vector of this length in the first block
                for _ in rest():
                    pass
                continue
            alone = int(math.isqrt(8 * group[1] + 1) - 1) // 2
            diagonal = group[1] == alone * (alone + 3) // 2
            if not diagonal and (ahead is None or ahead[0][:2] != group):
                continue
            for found in resolve(_joined(first), rest(), threshold):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=schema)

    return (dealt.repartition(pairs, "dim", "pair").sortWithinPartitions("dim", "pair", "side")
            .mapInArrow(run, schema_text))


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE d AS (
  SELECT vec_id, row_number() OVER () AS r, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), v AS (
  SELECT vec_id, r, e FROM d
  WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
), l AS (
  SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), r AS (
  SELECT r AS x, r AS y FROM d
  UNION
  SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
), c AS (
  SELECT r.x, min(d.vec_id) AS component_id FROM r JOIN d ON r.y = d.r GROUP BY r.x
), n AS (
  SELECT x, count(*) AS n FROM l GROUP BY x
)
SELECT d.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id,
  d.vec_id = c.component_id AS kept
FROM d JOIN c ON d.r = c.x LEFT JOIN n ON d.r = n.x
"""
