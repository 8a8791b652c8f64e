"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its word shingles (64-bit hashes). All sets share one
order of tokens: by frequency class, then by hash. Classes come from a sketch
of counters, of fixed size, over the tokens of all documents. Two sets that
reach the threshold share two tokens or more in prefixes that are one token
longer than the plain prefix filter needs. So a prefix is indexed by single
tokens where they are rare, and by pairs of tokens where they are frequent; a
size class in each key keeps sets of very different sizes apart. In classes of
very long sets, where pairs would be too many, frequent tokens are indexed
singly by the plain prefix. No link is lost.

Identical sets are one node. Each index key first offers only the pairs of its
least node; the nodes' best pairs are verified on the whole sets and joined to
components, and so are random neighbours among the members of each key. Then
all other pairs that share a key and still lie in different components are
verified. A bitmap of token parities, whose differences are
never more than the sets' differences, rules out most pairs before that.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shortbook.llm.common import _arrow_schema, free_memory, map_rows, stored, table
from shortbook.llm.components import components

SHINGLE, PERCENT = 3, 90
# counters of the frequency sketch, and of one row of its shuffle
SKETCH_BITS, CHUNK_BITS = 21, 15
# a token is frequent above this many documents and this many times the mean counter
FREQUENT, FREQUENT_MEANS = 64, 8
# size classes grow by this factor; pairs are used in classes whose prefixes are no longer
CLASS_RATIO, PAIR_PREFIX = 1.5, 40
PARITY_BITS = 512
MEMO_WORDS = 200_000
NODE_SCHEMA = "doc_id long, n long, node long, parity array<long>, keys array<long>"

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MUL2
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of a text, sorted; words hashed through a memo."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.memo: dict[bytes, int] = {}

    def __call__(self, raw: bytes | None) -> np.ndarray:
        # bytes.lower and bytes.split know ASCII only: A-Z, and \x20 \x09-\x0D
        words = (raw or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        for w in dict.fromkeys(words):
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        m = len(h) - size + 1
        s = np.full(m, size, np.uint64)
        for k in range(size):
            s = _mix(s * _MUL + h[k:k + m])
        return np.unique(s)


def prefix_length(n: int, percent: int) -> int:
    """Tokens that need indexing so that linked sets share one of them."""
    return n - -(-percent * n // 100) + 1


def size_classes(n: int, percent: int) -> list[int]:
    """The class of a set, and the next if linked larger sets may be in it."""
    own = int(math.log(n) / math.log(CLASS_RATIO) + 1e-9)
    most = int(math.log(n * 100 / percent) / math.log(CLASS_RATIO) + 2e-9)
    return list(range(own, most + 1))


def class_prefix(c: int, percent: int) -> int:
    return prefix_length(int(CLASS_RATIO ** (c + 1)) + 1, percent) + 1


def node_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def index_keys(tokens: np.ndarray, classes: np.ndarray, frequent: int, percent: int) -> np.ndarray:
    """Index keys of a set. ``classes``: each token's frequency class."""
    n = len(tokens)
    plain = prefix_length(n, percent)
    if 100 * n // percent == n:
        return np.zeros(0, np.int64)  # no larger set, so only an equal one is similar enough
    order = np.lexsort((tokens, classes))[:plain + 1]
    t, often = tokens[order], classes[order] >= frequent
    found = []
    for c in size_classes(n, percent):
        salt = np.uint64((2 * c + 1) * 0x9E3779B97F4A7C15 % 2**64)
        if class_prefix(c, percent) > PAIR_PREFIX:
            found.append(_mix(t[:plain] ^ salt))
            continue
        found.append(_mix(t[~often] ^ salt))
        f = np.sort(t[often])
        a, b = np.triu_indices(len(f), 1)
        found.append(_mix(_mix(f[a] ^ salt) * _MUL + f[b]))
    return np.unique(np.concatenate(found)).view(np.int64)


def parity(tokens: np.ndarray) -> np.ndarray:
    """Bit k: whether an odd number of tokens falls on it. The bits in which
    two sets differ are no more than the tokens in which they differ. Larger
    sets have more bits, by powers of two; adding the halves of a bitmap up
    makes the one of half its size."""
    size = PARITY_BITS
    while size < len(tokens):
        size *= 2
    bits = np.bincount(((tokens >> np.uint64(7)) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def frequency_classes(raw: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """log2 classes of the sketch's counters over all documents, and the class
    from which on a token is frequent. One byte a counter reaches the driver,
    2 MB whatever the data. Tasks send their counters in chunks; a chunk is
    summed as a stream, never gathered."""
    schema = "chunk int, counts binary"
    arrow = _arrow_schema(raw.sparkSession, schema)
    width = 1 << CHUNK_BITS

    def batch(chunk: int, counts: np.ndarray) -> pa.RecordBatch:
        data = zlib.compress(counts.astype("<u4").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([data])], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, total = Shingler(size), np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            held: list[np.ndarray] = []
            for text in b.column(0).to_pylist():
                held.append((make(text) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                if sum(map(len, held[-64:])) > 1 << 18 or len(held) >= 4096:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held = []
            if held:
                total += np.bincount(np.concatenate(held), minlength=len(total))
        if total.any():
            for k in range(len(total) // width):
                yield batch(k, total[k * width:(k + 1) * width])
        make.memo.clear()
        free_memory()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
                sums[k] = sums[k] + own if k in sums else own
        for k, own in sums.items():
            yield batch(k, np.minimum(own, 2**32 - 1))

    rows = raw.select("raw").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema).collect()
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in rows:
        total[r.chunk * width:(r.chunk + 1) * width] = np.frombuffer(zlib.decompress(r.counts), "<u4")
    least = max(FREQUENT, FREQUENT_MEANS * total.mean())
    return np.log2(np.maximum(total, 1)).astype(np.uint8), int(np.log2(least))


def signed_documents(raw: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, node, parity, keys): node is a hash of the set."""
    classes, frequent = frequency_classes(raw, size)
    shared = raw.sparkSession.sparkContext.broadcast(classes)

    schema = _arrow_schema(raw.sparkSession, NODE_SCHEMA)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, own = Shingler(size), shared.value
        seen: set[int] = set()  # a task gives the keys of a set once, as far as the memo goes
        for b in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = make(text)
                node, keys = node_of(t), np.zeros(0, np.int64)
                if len(t) and node not in seen:
                    cls = own[(t >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    keys = index_keys(t, cls, frequent, percent)
                    if len(seen) >= MEMO_WORDS:
                        seen.clear()
                    seen.add(node)
                for name, v in zip(out, (doc_id, len(t), node, parity(t), keys), strict=True):
                    out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        make.memo.clear()
        seen.clear()
        free_memory()

    return raw.select("doc_id", "raw").mapInArrow(sign, NODE_SCHEMA)


def _close(n1: Column, n2: Column, p1: Column, p2: Column, percent: int) -> Column:
    """Necessary for a link: sizes, and the parities' differing bits. Linked
    sets differ in at most (n1 + n2)(100 - p)/(100 + p) tokens."""
    def fold(p: Column, other: Column) -> Column:
        """Linked sets differ in size by less than a factor of two."""
        half = F.shiftright(F.size(p), 1)
        both = F.zip_with(F.slice(p, 1, half), F.slice(p, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(p) > F.size(other), both).otherwise(p)

    bits = F.aggregate(F.zip_with(fold(p1, p2), fold(p2, p1),
                                  lambda a, b: F.coalesce(F.bit_count(a.bitwiseXOR(b)).cast("int"), F.lit(0))),
                       F.lit(0), lambda s, x: s + x)
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * bits <= (100 - percent) * (n1 + n2)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of (u, v), by the intersection of the whole sets."""
    left = sets.select(F.col("node").alias("u"), F.col("tokens").alias("t1"))
    right = sets.select(F.col("node").alias("v"), F.col("tokens").alias("t2"))
    return (pairs.select("u", "v").join(left, "u").join(right, "v")
            .withColumn("both", F.size(F.array_intersect("t1", "t2")))
            .filter(100 * F.col("both") >= percent * (F.size("t1") + F.size("t2") - F.col("both")))
            .select("u", "v"))


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Documents link when 100 |A and B| >= percent |A or B|; component_id is the
    least id reachable by links. Fewer words than ``size`` are one shingle; a
    null text, an empty one and one of white space have the empty set and link
    with nothing. Repeated rows each get a row. A null id links like any
    other; it is a component's id only where no other id is there. Other
    columns are not read; an empty table gives no rows.
    """
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).cast("string").cast("binary").alias("raw"))
    signed = stored(signed_documents(raw, size, percent), "signed")
    nodes = (signed.filter("size(keys) > 0").groupBy("node")
             .agg(F.first("n").alias("n"), F.first("parity").alias("parity")))
    # keys that several nodes share, with their least node; only numbers are
    # shuffled, once, and a hot key's frame spills
    of_key = Window.partitionBy("key")
    members = stored(signed.select("node", F.explode("keys").alias("key"))
                     .withColumns({"hub": F.min("node").over(of_key), "last": F.max("node").over(of_key)})
                     .filter("hub != last").select("key", "node", "hub").distinct(), "members")
    near = (members.filter("node != hub").groupBy(F.col("node").alias("u"), F.col("hub").alias("v"))
            .agg(F.count("*").alias("shared")))
    hub_pairs = stored(_parity_filter(near, nodes, percent), "hub-pairs")
    best = hub_pairs.groupBy("u").agg(F.max_by("v", F.struct("shared", "v")).alias("v"))
    links = stored(_verified(best, _sets_of(raw, signed, best, size), percent), "links")
    found = stored(components(links), "first-components")

    # large groups join up by random neighbours: every key has an order of its own
    ring = Window.partitionBy("key").orderBy(F.xxhash64("node", "key"), "node")
    ringed = _labelled(members, found).withColumns({
        "v": F.lead("node").over(ring), "cv": F.lead("component").over(ring)})
    near = (ringed.filter("v is not null and component != cv")
            .select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v"), F.lit(1).alias("shared"))
            .distinct())
    rings = stored(_parity_filter(near, nodes, percent).select("u", "v"), "ring-pairs")
    links = links.union(stored(_verified(rings, _sets_of(raw, signed, rings, size), percent), "ring-links"))
    found = stored(components(links), "second-components")

    # what is left: pairs that share a key and lie in different components
    lost = _labelled(members, found)
    open_keys = (lost.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"),
                                         F.count("*").alias("count"))
                 .filter("a != b and count > 2").select("key"))
    side = lost.filter("node != hub").join(open_keys, "key").select("key", "node", "component")
    side = stored(side.join(nodes, "node"), "open-members")
    other = side.select("key", *[F.col(c).alias(f"{c}_2") for c in ("node", "n", "component", "parity")])
    rest = (side.join(other, "key").filter(
        (F.col("node") < F.col("node_2")) & (F.col("component") != F.col("component_2"))
        & _close(F.col("n"), F.col("n_2"), F.col("parity"), F.col("parity_2"), percent))
        .select(F.col("node").alias("u"), F.col("node_2").alias("v")))
    label = found.select("node", "component")
    untested = (hub_pairs.join(best.withColumnRenamed("v", "best"), "u").filter("v != best").select("u", "v")
                .join(label.withColumnRenamed("node", "u").withColumnRenamed("component", "cu"), "u", "left")
                .join(label.withColumnRenamed("node", "v").withColumnRenamed("component", "cv"), "v", "left")
                .filter(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v"))
    rest = stored(rest.union(untested).distinct(), "open-pairs")
    more = stored(_verified(rest, _sets_of(raw, signed, rest, size), percent), "more-links")
    whole = components(links.union(more))

    label = signed.select("doc_id", "n", "node").join(whole, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = label.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (label.join(least, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _parity_filter(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    a = nodes.select(F.col("node").alias("u"), F.col("n").alias("n1"), F.col("parity").alias("p1"))
    b = nodes.select(F.col("node").alias("v"), F.col("n").alias("n2"), F.col("parity").alias("p2"))
    return (pairs.join(a, "u").join(b, "v")
            .filter(_close(F.col("n1"), F.col("n2"), F.col("p1"), F.col("p2"), percent))
            .select("u", "v", "shared"))


def _sets_of(raw: DataFrame, signed: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(node, tokens) of the nodes in ``pairs``, from one document of each."""
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    one = stored(signed.join(wanted, "node", "left_semi").groupBy("node")
                 .agg(F.min("doc_id").alias("least")), "wanted")

    def sets(cols: dict[str, list]) -> dict[str, list]:
        make = Shingler(size)
        tokens = [make(t) for t in cols["raw"]]
        return {"node": [node_of(t) for t in tokens],
                "tokens": [t.view(np.int64) for t in tokens]}

    own = raw.join(one.select("least").distinct(), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    made = map_rows(own.select("raw"), sets, "node long, tokens array<long>")
    return stored(made.join(one.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS k FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM c JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id
  WHERE 100 * c >= 90 * (a.n + b.n - c)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT r.x, l.y FROM r JOIN l ON r.y = l.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM d JOIN r ON d.doc_id = r.x LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""
