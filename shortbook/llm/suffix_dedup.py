"""Removal of byte strings that an earlier document has too.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller id is removed. Equal strings pick the same anchor: the leftmost
least of their ``GRAM``-byte hashes. Documents that share no anchor share no
string, so only anchors of two documents or more are followed. An anchor's
surroundings (all strings that pick it) go to one group, in which a merge sort
brings equal strings together: suffixes are compared by their longest common
extension, found by binary search on prefix polynomial hashes, and strings that
compare equal are verified byte by byte. Equal surroundings are sorted once.
Anchors of very many documents send each string to a group of its own, which is
read as a stream. Documents whose whole text a smaller one has take no part in
this: all of it goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shortbook.llm.common import _arrow_schema, free_memory, release, stored, table, text_of

LENGTH, GRAM = 50, 20
SPAN = LENGTH - GRAM + 1
# an anchor of more documents is split by string
HOT = 2_000
# suffixes sorted at once, if a group is not larger; their hashes fit into a core's cache
SORT_SUFFIXES = 30_000
# places of a text looked at together for anchors
PIECE = 1 << 16
# rows that are looked at together, if a group is not larger, and rows of a batch
GROUP_ROWS, BATCH_ROWS = 60_000, 20_000
BASE = 0x9E3779B97F4A7C15
CONTEXTS = "key long, doc long, copy int, start long, context binary"
_MAX = 2**63 - 1


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(
                np.full(size - 1, b, np.uint64))]) for b in (BASE, pow(BASE, -1, 2**64)))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of (byte j + 1) * BASE**j for j < i, modulo 2**64."""
    up, _ = POWERS.get(len(data))
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=h[1:])
    return h


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, end): per anchor occurrence its hash, its place and
    the range of starts of the strings that pick it. Strings pick the leftmost least of
    their mixed gram hashes."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none
    data = np.frombuffer(raw, np.uint8)
    h = prefix_hashes(data)
    n = len(data) - GRAM + 1
    value = (h[GRAM:] - h[:n]) * POWERS.get(n)[1]
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(32)
    # the high bits of a hash and its place in one number, whose minimum is the leftmost least
    place_bits = np.uint64(2 * PIECE - 1)
    picked = []
    for k in range(0, n - SPAN + 1, PIECE):
        least = value[k:k + PIECE + SPAN - 1] & ~place_bits
        least |= np.arange(len(least), dtype=np.uint64)
        width = 1
        while width < SPAN:  # least over [i, i + width), doubled and then overlapped
            step = min(width, SPAN - width)
            least = np.minimum(least[step:], least[:-step])
            width += step
        picked.append((least & place_bits).astype(np.int64) + k)
    at = np.concatenate(picked)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return value[at[first]].view(np.int64), at[first], first, np.append(first[1:], len(at))


def common_extension(h: np.ndarray, down: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes, up to LENGTH, in which the suffixes at a and b agree."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH, np.int64)
    h_a, h_b, down_a, down_b = h[a], h[b], down[a], down[b]
    for _ in range(LENGTH.bit_length()):  # enough halvings for LENGTH + 1 lengths
        middle = (low + high + 1) >> 1
        same = (h[a + middle] - h_a) * down_a == (h[b + middle] - h_b) * down_b
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sort_suffixes(data: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes ``at`` by their first LENGTH bytes within their
    group; groups are contiguous. A bottom-up merge sort, vectorised over all
    pairs of runs of a level: every suffix finds its rank in the other run by
    binary search. Only groups that cross a boundary of runs take part."""
    n = len(at)
    h, down = prefix_hashes(data), POWERS.get(len(data) + 1)[1]
    padded = np.append(data, 0)

    def before(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        common = common_extension(h, down, x, y)
        return np.where(common == LENGTH, or_equal, padded[x + common] < padded[y + common])

    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(edges, n))
    start, end = np.repeat(edges, sizes), np.repeat(edges + sizes, sizes)
    order = np.arange(n)
    width = 1
    while width < (sizes.max() if n else 0):
        # runs are counted from the start of the group
        place = np.arange(n)
        run = (place - start) // width
        low = start + (run ^ 1) * width
        high = np.minimum(low + width, end)
        active = np.flatnonzero(low < end)
        if len(active):
            mine = at[order[active]]
            left = (run[active] & 1) == 0
            lo, hi = low[active].copy(), high[active]
            base = lo.copy()
            while True:
                todo = np.flatnonzero(lo < hi)
                if not len(todo):
                    break
                middle = (lo[todo] + hi[todo]) >> 1
                other = at[order[middle]]
                # the other run's suffix goes first: on ties only if it is the left run
                goes = before(other, mine[todo], ~left[todo])
                lo[todo] = np.where(goes, middle + 1, lo[todo])
                hi = hi.copy()
                hi[todo] = np.where(goes, hi[todo], middle)
            shift = np.where(left, 0, -width)
            new = order.copy()
            new[active + shift + lo - base] = order[active]
            order = new
        width *= 2
    return order


def gather(data: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """data[begin[0]:begin[0] + lens[0]], data[begin[1]:...] and so on, joined."""
    ends = np.cumsum(lens)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - lens), lens)]


def earlier_windows(data: np.ndarray, lens: np.ndarray, lead: np.ndarray, docs: np.ndarray,
                    groups: np.ndarray) -> np.ndarray:
    """For each string of the contexts, joined in ``data``, whether another
    context of its group has it with a smaller document. ``lead`` is the distance from a
    context's first string to the anchor: equal strings stand at equal
    distances, so only those are compared."""
    begin = np.cumsum(lens) - lens
    data = np.append(data, np.zeros(LENGTH, np.uint8))
    count = lens - LENGTH + 1
    owner = np.repeat(np.arange(len(lens)), count)
    first = np.cumsum(count) - count
    nth = np.arange(count.sum()) - np.repeat(first, count)
    at = nth + np.repeat(begin, count)
    # bring the strings of a group and distance together, then sort those
    number = np.cumsum(np.append(0, groups[1:] != groups[:-1]))
    place = number[owner] * (2 * LENGTH) + (lead[owner] - nth) + LENGTH
    together = np.argsort(place, kind="stable")
    order = together[sort_suffixes(data, at[together], place[together])]
    a, b = at[order[:-1]], at[order[1:]]
    same = np.zeros(len(order), bool)
    h, down = prefix_hashes(data), POWERS.get(len(data) + 1)[1]
    same[1:] = (place[order[:-1]] == place[order[1:]]) \
        & ((h[a + LENGTH] - h[a]) * down[a] == (h[b + LENGTH] - h[b]) * down[b])
    check = np.flatnonzero(same)
    for k in range(0, len(check), 100_000):  # equal hashes are verified
        rows = check[k:k + 100_000]
        window = np.arange(LENGTH)
        x, y = data[at[order[rows - 1]][:, None] + window], data[at[order[rows]][:, None] + window]
        same[rows] = (x == y).all(axis=1)
    runs = np.flatnonzero(~same)
    least = np.minimum.reduceat(docs[owner[order]], runs) if len(runs) else docs[:0]
    smallest = np.empty(len(order), docs.dtype)
    smallest[order] = np.repeat(least, np.diff(np.append(runs, len(order))))
    return smallest < docs[owner]


def binary_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, length) of a binary column's values."""
    ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends[:-1], np.diff(ends)


def partly_gone(data: np.ndarray, begin: np.ndarray, lens: np.ndarray, least: np.ndarray,
                groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, from, to): the ranges of strings that other contexts of the
    group have with a smaller document, sorted. Groups of one context or of one document
    have none; the others are sorted some groups at a time."""
    edges = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    mixed = np.minimum.reduceat(least, edges) < np.maximum.reduceat(least, edges)
    todo = np.flatnonzero(np.repeat(mixed, np.diff(np.append(edges, len(groups)))))
    found = []
    while len(todo):
        suffixes = np.cumsum(lens[todo] - LENGTH)
        last = groups[todo[min(np.searchsorted(suffixes, SORT_SUFFIXES), len(todo) - 1)]]
        now, todo = np.split(todo, [np.searchsorted(groups[todo], last, "right")])
        size = lens[now] - 1
        gone = earlier_windows(gather(data, begin[now] + 1, size), size, data[begin[now]].astype(np.int64),
                               least[now], groups[now])
        count = size - LENGTH + 1
        owner = np.repeat(np.arange(len(now)), count)
        opens = np.append(True, owner[1:] != owner[:-1])
        before, after = np.append(False, gone[:-1]) & ~opens, np.append(gone[1:], False) & ~np.append(opens[1:], True)
        a, b = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        first = np.cumsum(count) - count
        found.append((now[owner[a]], a - first[owner[a]], b + 1 - first[owner[b]]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def resolve(rows: pa.Table, last: bool) -> tuple[list[np.ndarray], pa.Table]:
    """([doc, copy, begin, end], rest) of rows sorted by (key, doc). The last
    key may go on unless ``last``, so its rows are the rest; if it is the only one,
    those rows are done whose surroundings a smaller document has."""
    key, doc, copy, start = (rows[c].to_numpy() for c in ("key", "doc", "copy", "start"))
    cut = len(key) if last else int(np.searchsorted(key, key[-1]))
    rest = rows.slice(cut)
    alone = cut == 0
    if not alone:
        key, doc, copy, start = key[:cut], doc[:cut], copy[:cut], start[:cut]
        rows = rows.slice(0, cut)
    coded = rows["context"].combine_chunks().dictionary_encode()
    # codes are numbered as they appear, so a code's first row has its least document
    code, (data, begin, lens) = coded.indices.to_numpy(), binary_parts(coded.dictionary)
    top = np.maximum.accumulate(code)
    first = np.flatnonzero(np.append(True, top[1:] > top[:-1]))
    least = doc[first]
    whole = doc > least[code]
    parts = [[doc[whole], copy[whole], start[whole], start[whole] + lens[code[whole]] - 1]]
    if alone:
        return parts[0], rest.filter(pa.array(~whole))
    context, a, b = partly_gone(data, begin, lens, least, key[first])
    count = np.bincount(context, minlength=len(first))
    own = np.flatnonzero(~whole & (count[code] > 0))
    many = count[code[own]]
    row = np.repeat(own, many)
    span = gather(np.arange(len(context)), (np.cumsum(count) - count)[code[own]], many)
    parts.append([doc[row], copy[row], start[row] + a[span], start[row] + b[span] + LENGTH - 1])
    return [np.concatenate(c) for c in zip(*parts, strict=True)], rest


def duplicated(docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, wholes, removed): the texts as bytes by document; per document
    the ``copy`` numbers of its texts that a smaller document has too; and the
    byte ranges (doc, copy, begin, end) to remove from the others, which may
    overlap."""
    spark = docs.sparkSession
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        # a null id counts as the largest
        F.coalesce(F.col(id_col).cast("long"), F.lit(_MAX)).alias("doc"),
        # tells apart the rows of one id
        F.hash(text_of(F.col(text_col))).alias("copy"),
        text_of(F.col(text_col)).cast("binary").alias("raw"))

    # texts that a smaller document has as a whole: all their strings go. Least documents are
    # aggregated before the shuffle and joined back, so a text of very many documents can be split
    signed = own.select("doc", "copy", F.unhex(F.sha2("raw", 256)).alias("of_text"))
    least = (signed.groupBy("of_text").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
             .filter("least < most").select("of_text", "least"))
    wholes = stored(signed.join(least, "of_text").filter("least < doc")
                    .groupBy("doc").agg(F.collect_set("copy").alias("whole")), "whole-copies")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(anchors(r)[0]) for r in b.column("raw").to_pylist()]
            if found:
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))],
                    names=["doc", "anchors"])
        free_memory()

    # one shuffle by anchor; the frame of a hot anchor spills, and its rows are pairs of numbers
    of_anchor = Window.partitionBy("anchor")
    shared = (own.select("doc", "raw").mapInArrow(find, "doc long, anchors array<long>")
              .select("doc", F.explode("anchors").alias("anchor"))
              .withColumns({"n": F.count("*").over(of_anchor), "a": F.min("doc").over(of_anchor),
                            "b": F.max("doc").over(of_anchor)})
              .filter("a != b").withColumn("hot", F.col("n") > HOT))
    # stored, so that the anchors' shuffle files can go before the texts move
    per_doc = (stored(shared.select("doc", "anchor", "hot"), "shared-anchors", "zstd").groupBy("doc")
               .agg(F.collect_list(F.when(~F.col("hot"), F.col("anchor"))).alias("some"),
                    F.collect_list(F.when(F.col("hot"), F.col("anchor"))).alias("many")))
    release(spark)
    # both uses of the texts read all its columns, so that one shuffle serves them
    texts = own.repartition("doc")

    context_schema = _arrow_schema(spark, CONTEXTS)

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some, many = (list_parts(b.column(c)) for c in ("some", "many"))
            for k, (doc, copy, raw, whole) in enumerate(zip(
                    *(b.column(c).to_pylist() for c in ("doc", "copy", "raw", "whole")), strict=True)):
                if copy in (whole or ()):
                    continue
                for out in shared_contexts(raw, some(k), many(k)):
                    n = len(out[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0]), pa.array(np.full(n, doc)), pa.array(np.full(n, copy, np.int32)),
                         pa.array(out[1]), out[2]], schema=context_schema)
        free_memory()

    def in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One document gives few rows; they leave in larger batches."""
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in surroundings(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= BATCH_ROWS:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    contexts = (texts.join(per_doc.join(wholes, "doc", "left"), "doc")
                .select("doc_id", "doc", "copy", "raw", "some", "many", "whole").mapInArrow(in_batches, CONTEXTS))
    schema_text = "doc long, copy int, begin long, end long"
    schema = _arrow_schema(spark, schema_text)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, limit = 0, GROUP_ROWS

        def done(last: bool) -> pa.RecordBatch:
            nonlocal held, rows, limit
            found, rest = resolve(pa.Table.from_batches(held), last)
            held, rows = rest.to_batches(), rest.num_rows
            limit = max(GROUP_ROWS, 2 * rows)  # what one key holds back is not looked at for every batch
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(found, schema, strict=True)], schema=schema)

        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
                if rows >= limit:
                    yield done(False)
        if rows:
            yield done(True)
        held.clear()
        free_memory()

    removed = (contexts.repartition("key").sortWithinPartitions("key", "doc")
               .mapInArrow(ranges, schema_text))
    return texts, wholes, removed


def list_parts(col: pa.ListArray) -> Callable[[int], np.ndarray]:
    """The values of a row of a list column, by its number; a null is empty."""
    ends, values = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)
    return lambda k: values[ends[k]:ends[k + 1]]


def shared_contexts(raw: bytes, some: np.ndarray, many: np.ndarray) -> Iterator[tuple]:
    """(key, start, context) columns: the surroundings of the anchors in
    ``some``, and every string of those in ``many`` by itself, keyed by its own
    hash. A context's first byte is the distance from its start to the anchor."""
    value, place, first, end = anchors(raw)
    data = np.frombuffer(raw, np.uint8)
    rows = np.flatnonzero(np.isin(value, some))
    key, start, size, lead = value[rows], first[rows], (end - first)[rows] + LENGTH - 1, (place - first)[rows]
    hot = np.flatnonzero(np.isin(value, many))
    if len(hot):
        at = gather(np.arange(end[-1]), first[hot], (end - first)[hot])
        h, down = prefix_hashes(data), POWERS.get(len(data) + 1)[1]
        own = (h[at + LENGTH] - h[at]) * down[at]
        key, start = np.append(key, own.view(np.int64)), np.append(start, at)
        size, lead = np.append(size, np.full(len(at), LENGTH)), np.append(lead, np.zeros(len(at), np.int64))
    shifted = np.append(np.uint8(0), data)  # a context begins one byte before its text
    for k in range(0, len(key), BATCH_ROWS):
        part = slice(k, k + BATCH_ROWS)
        lens = size[part] + 1
        ends = np.append(0, np.cumsum(lens))
        joined = gather(shifted, start[part], lens)
        joined[ends[:-1]] = lead[part]
        yield key[part], start[part], pa.BinaryArray.from_buffers(
            pa.binary(), len(lens), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(joined)])


def covered(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges; touching ranges are one."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
    return begin[first], reach[np.append(first[1:], len(reach)) - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of
    ``docs``; with ``keep_bytes`` also ``kept``, the remaining bytes.

    A null text is empty. Documents with the same id do not remove from each
    other; repeated rows each get a row. A null id counts as larger than all
    others. Other columns are not read; an empty table gives no rows.
    """
    texts, wholes, removed = duplicated(docs, id_col, text_col)
    ranges = (removed.groupBy("doc").agg(F.collect_list(F.struct("copy", "begin", "end")).alias("ranges"))
              .select("doc", *[F.col(f"ranges.{c}").alias(c + "s") for c in ("copy", "begin", "end")])
              .join(wholes, "doc", "full"))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema_text = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    schema = _arrow_schema(docs.sparkSession, schema_text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, begins, ends = (list_parts(batch.column(c)) for c in ("copys", "begins", "ends"))
            out: dict[str, list] = {n: [] for n in names}
            for k, (doc_id, copy, raw, whole) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "copy", "raw", "whole")), strict=True)):
                mine = copies(k) == copy
                begin, end = begins(k)[mine], ends(k)[mine]
                if copy in (whole or ()) and len(raw) >= LENGTH:
                    begin, end = np.array([0]), np.array([len(raw)])
                data = raw
                if len(begin):
                    begin, end = covered(begin, end)
                    data = b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)],
                                                             strict=True))
                for name, v in zip(names, (doc_id, len(raw), len(raw) - len(data), len(begin),
                                           hashlib.sha256(data).hexdigest(), data if keep_bytes else None),
                                   strict=True):
                    out[name].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)
        free_memory()

    made = (texts.join(ranges, "doc", "left")
            .select("doc_id", "copy", "raw", "copys", "begins", "ends", "whole").mapInArrow(cut, schema_text))
    return made if keep_bytes else made.drop("kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
