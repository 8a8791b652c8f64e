"""Which tokens of two vocabularies stand for the same bytes.

A text's bytes are cut into tokens twice. Where a token of A and one of B both
end, a group ends; a token of A and one of B whose bytes overlap are linked.
The count of an id pair is the number of documents in which it is linked.

A first pass encodes and aligns the documents and stores them in blocks: the
distinct linked pairs of a block, how many of its documents have each, and
every link of every document as its pair's place among them. All pairs get a
slot each by minimal perfect hashing (built per bucket, verified by the keys).
Tasks add the documents of their blocks into dense vectors over the slots; the
vectors travel in stretches and are summed as a tree, first within groups of
tasks, then over the groups. A last pass looks the pairs of each block up and
sums over the links. Pairs are taken in shards, by the id of A, of a bounded
number each, so that what a task holds is bounded too: a corpus with more pairs
takes more turns.

Neither vocabulary joins anything across a chunk's edge (a run of spaces and
newlines with what follows it), which is checked when the files are read. So
chunks are encoded once and kept in a bounded memo, and both a token of A and
one of B end at each edge: a text's links and groups are those of its chunks,
and a block aligns each of its distinct chunks once.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import _arrow_schema, free_memory, stored, table
from shortbook.llm.perfect_hash import PerfectHash, bucket_of, build_bucket
from shortbook.llm.token_files import CHUNK, OTHER_SPACE, Encoder, byte_alphabet

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# pairs of a shard, of a bucket, and of a stretch of counts
PAIRS_AT_ONCE, BUCKET_PAIRS, STRETCH = 1 << 23, 1 << 17, 1 << 18
# chunks of a memo, tokens aligned at once, and distinct pairs that a task gathers before it sends them
MEMO_CHUNKS, TOKENS_AT_ONCE, SENT = 300_000, 1 << 19, 1 << 21
# new chunks encoded at once, and characters after which a block ends
CHUNKS_AT_ONCE, BLOCK_CHARS = 20_000, 1 << 21
# numbers: n_a, n_b, n_groups and n_links of each document; links: places in pairs; seen: documents with a pair
BLOCKS = "doc_ids array<long>, numbers binary, hashes binary, links binary, pairs binary, seen binary"
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


class Alignment:
    """Texts aligned one after another: their ids, and the bytes of each. The
    links and the groups of text k end at ``link_ends[k]`` and ``group_ends[k]``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, sizes: np.ndarray):
        self.a, self.b = a, b
        self.a_end, self.b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        ends = np.sort(np.concatenate([self.a_end, self.b_end]), kind="stable")
        last = np.append(ends[1:] != ends[:-1], True)[:len(ends)]
        self.both = ends[~last]  # A and B have each end once
        ends = ends[last]
        # a stretch between two ends lies in one token of A and one of B, and in no other stretch do they meet
        self.links = (a[np.searchsorted(self.a_end, ends)].astype(np.uint64) << np.uint64(32)) \
            | b[np.searchsorted(self.b_end, ends)].astype(np.uint64)
        texts = np.cumsum(sizes)
        self.a_ends, self.b_ends, self.link_ends, self.group_ends = (
            np.searchsorted(of, texts, "right") for of in (self.a_end, self.b_end, ends, self.both))

    def texts(self, names: tuple[list[str], ...]) -> list[str]:
        """Per text its groups as ``a1,a2|b1;``."""
        a_comma, a_bar, b_comma, b_semicolon = names
        a_group, b_group = np.searchsorted(self.both, self.a_end), np.searchsorted(self.both, self.b_end)
        parts = [(last if end else more)[i] for of, group, more, last in (
            (self.a, a_group, a_comma, a_bar), (self.b, b_group, b_comma, b_semicolon))
            for i, end in zip(of.tolist(), np.append(group[1:] != group[:-1], True)[:len(of)].tolist(), strict=True)]
        group = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], 2 * self.group_ends).tolist()
        parts = [parts[k] for k in order.tolist()]
        return ["".join(parts[x:y]) for x, y in zip([0, *cuts], cuts, strict=False)]


@functools.cache
def _vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.encoder = Encoder(a_path, special=False)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in byte_alphabet().items()}
        with open(a_path, encoding="utf-8") as f:
            found = json.load(f)
        entries = found["model"]["vocab"] | {t["content"]: t["id"] for t in found["added_tokens"]}
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        n, name = self.pieces.get_piece_size(), self.pieces.id_to_piece
        self.b_bytes = [bytes([int(name(i)[3:5], 16)]) if self.pieces.is_byte(i)
                        else name(i).replace("▁", " ").encode() for i in range(n)]
        self.a_size, self.b_size = (np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes))
        # chunks may be encoded alone if no piece crosses their edges and a newline stays by itself
        plain = [name(i) for i in range(n) if not (self.pieces.is_byte(i) or self.pieces.is_control(i)
                                                   or self.pieces.is_unknown(i))]
        crossing = re.compile(r"[^▁]▁|\n|[A-Za-zÀ-ÖØ-öø-ɏ][\x00-@\[-`{-\x7F]")
        self.lead = self.pieces.encode("\n")
        self.chunks = self.encoder.bytes is not None and len(self.lead) == 2 and not any(map(crossing.search, plain))
        self.memo: dict[str, tuple[bytes, bytes] | None] = {}
        self.old: dict[str, tuple[bytes, bytes] | None] = {}

    @functools.cache  # noqa: B019 - there is one object a process
    def names(self) -> tuple[list[str], ...]:
        """An id with the separator behind it, for ids of A and of B."""
        return tuple([f"{i}{mark}" for i in range(len(of))]
                     for of, mark in ((self.a_bytes, ","), (self.a_bytes, "|"), (self.b_bytes, ","), (self.b_bytes, ";")))

    def encode(self, text: str | None) -> tuple[bytes, bytes] | None:
        """Ids of A and of B as u32; None if the text has no tokens."""
        found, parts, _ = self.parts([text])
        return tuple(b"".join([found[k][side] for k in parts.tolist()]) for side in (0, 1)) if len(parts) else None

    def parts(self, texts: list[str | None]) -> tuple[list[tuple[bytes, bytes] | None], np.ndarray, np.ndarray]:
        """The ids of the texts' distinct parts, the parts of one text after
        another as places among them, and their number per text: none, if the
        text has no tokens. A part is a chunk or a whole text."""
        whole = [bool(t) and not (self.chunks and not OTHER_SPACE.search(t)) for t in texts]
        cut = [CHUNK.findall(" " + t) if t and not w else [] for t, w in zip(texts, whole, strict=True)]
        sizes = np.array([len(c) for c in cut], np.int64)
        coded = pa.array([c for chunks in cut for c in chunks], pa.string()).dictionary_encode()
        found, parts = self._known(coded.dictionary.to_pylist()), coded.indices.to_numpy().astype(np.int64)
        if None in found:
            bad = np.array([x is None for x in found])
            whole = (np.bincount(np.repeat(np.arange(len(texts)), sizes), bad[parts], len(texts)) > 0) | whole
            parts, sizes = parts[~np.repeat(whole, sizes)], np.where(whole, 0, sizes)
        alone = [k for k, w in enumerate(whole) if w]
        if alone:
            at = np.append(0, np.cumsum(sizes))
            spaced = [" " + texts[k] for k in alone]
            ids = self._checked(spaced, self.encoder.raw(spaced), [self.pieces.encode(texts[k]) for k in alone])
            alone, ids = zip(*[x for x in zip(alone, ids, strict=True) if x[1]], strict=True) if any(ids) else ((), ())
            parts = np.insert(parts, at[list(alone)], np.arange(len(found), len(found) + len(ids)))
            found += ids
            sizes[list(alone)] = 1
        return found, parts, sizes

    def _known(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of distinct chunks, None where their bytes are not the chunk's."""
        new = set(chunks).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_CHUNKS:
            self.memo, self.old, new = {}, self.memo, set(chunks)
        self.memo.update((c, self.old[c]) for c in new.intersection(self.old))
        new = list(new.difference(self.old))
        for k in range(0, len(new), CHUNKS_AT_ONCE):
            own = new[k:k + CHUNKS_AT_ONCE]
            self.memo.update(zip(own, self._learned(own), strict=True))
        return list(map(self.memo.__getitem__, chunks))

    def _learned(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        raw = [c.encode() for c in chunks]
        ends = np.cumsum([len(r) for r in raw])
        raw = b"".join(raw)
        a = self._a_of(chunks)
        # behind a newline, whose tokens are dropped, B adds no space to a chunk
        b = [ids[len(self.lead):] for ids in self.pieces.encode(["\n" + c for c in chunks], num_threads=1)]
        a_ids = np.frombuffer(b"".join(a), "<u4")
        b_ids = np.fromiter(itertools.chain.from_iterable(b), "<u4")
        b_to = 4 * np.cumsum([len(ids) for ids in b])
        for ids, to, size, of in ((a_ids, np.cumsum([len(x) for x in a]), self.a_size, self.a_bytes),
                                  (b_ids, b_to, self.b_size, self.b_bytes)):
            at = np.append(0, np.cumsum(size[ids]))
            if not np.array_equal(at[to // 4], ends) or b"".join(map(of.__getitem__, ids.tolist())) != raw:
                return self._checked(chunks, a, b)
        data, to = b_ids.tobytes(), b_to.tolist()
        return list(zip(a, [data[m:n] for m, n in zip([0, *to], to, strict=False)], strict=True))

    def _a_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of A per chunk. Chunks between white space and another character
        can stand in a row, and are encoded at once."""
        row = [c for c in chunks if c[0] in " \n" and c[-1] not in " \n"]
        found = {}
        if row:
            data = self.encoder.raw(["".join(row)])[0]
            ids = np.frombuffer(data, "<u4")
            raw = [c.encode() for c in row]
            ends, at = np.cumsum([len(r) for r in raw]), np.cumsum(self.a_size[ids])
            last = np.searchsorted(at, ends)
            if b"".join(map(self.a_bytes.__getitem__, ids.tolist())) == b"".join(raw) and np.array_equal(at[last], ends):
                to = (4 * (last + 1)).tolist()
                found = dict(zip(row, [data[m:n] for m, n in zip([0, *to], to, strict=False)], strict=True))
        rest = [c for c in chunks if c not in found]
        found.update(zip(rest, self.encoder.chunk_ids(rest), strict=True))
        return [found[c] for c in chunks]

    def _checked(self, texts: list[str], a: list[bytes], b: list[list[int]]) -> list[tuple[bytes, bytes] | None]:
        """The ids of each text, or None where their bytes are not the text's."""
        out = []
        for text, x, y in zip(texts, a, b, strict=True):
            raw = text.encode()
            same = raw == b"".join([self.b_bytes[i] for i in y]) \
                and raw == b"".join([self.a_bytes[i] for i in struct.unpack(f"<{len(x) // 4}I", x)])
            out.append((x, struct.pack(f"<{len(y)}I", *y)) if same else None)
        return out

    def align(self, a: list[bytes], b: list[bytes], kind: str) -> Iterator[Alignment]:
        """Alignments of consecutive texts, given as ids of ``kind``; each of a
        bounded number of tokens, or of one text. No ids stand for no tokens."""
        a_len, b_len = (np.fromiter(map(len, of), np.int64, len(of)) // np.dtype(kind).itemsize for of in (a, b))
        tokens, k = np.append(0, np.cumsum(a_len + b_len)), 0
        while k < len(a):
            n = max(k + 1, int(np.searchsorted(tokens, tokens[k] + TOKENS_AT_ONCE, "right")) - 1)
            a_ids, b_ids = (np.frombuffer(b"".join(of[k:n]), kind).astype(np.int64) for of in (a, b))
            ends = np.cumsum(a_len[k:n])
            sizes = np.diff(np.append(0, np.cumsum(self.a_size[a_ids]))[np.append(0, ends)])
            yield Alignment(a_ids, b_ids, self.a_size, self.b_size, sizes)
            k = n


def places(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of consecutive stretches of ``values`` (the last axis)."""
    ends = np.append(0, np.cumsum(sizes))
    total = np.concatenate([np.zeros((*values.shape[:-1], 1), np.int64), np.cumsum(values, axis=-1)], axis=-1)
    return np.diff(total[..., ends], axis=-1)


def block(words: Vocabularies, ids: list[int | None], texts: list[str | None]) -> tuple:
    """A row of ``BLOCKS``."""
    found, parts, n_parts = words.parts(texts)
    # a chunk's place stays when texts with bytes that differ are taken whole
    found = [x or (b"", b"") for x in found]
    numbers, links, names = [np.zeros((4, 0), np.int64)], [np.zeros(0, np.uint64)], []
    for made in words.align([x[0] for x in found], [x[1] for x in found], "<u4"):
        numbers.append(np.diff([made.a_ends, made.b_ends, made.group_ends, made.link_ends], axis=1, prepend=0))
        links.append(made.links)
        names += [t.encode() for t in made.texts(words.names())]
    numbers, links = np.concatenate(numbers, axis=1), np.concatenate(links)
    pairs, links = np.unique(links, return_inverse=True)
    begins = np.cumsum(numbers[3]) - numbers[3]
    links = links[places(begins[parts], numbers[3][parts])]
    numbers = sums(numbers[:, parts], n_parts)
    seen = np.zeros(len(pairs), np.uint32)
    ends = np.cumsum(numbers[3]).tolist()
    for m, n in zip([0, *ends], ends, strict=False):
        seen[links[m:n]] += np.uint32(1)  # a place that comes twice counts once
    hashes, at = [], 0
    for n in n_parts.tolist():
        text = b"".join([names[k] for k in parts[at:at + n].tolist()])
        hashes.append(hashlib.sha256(text[:-1]).digest())
        at += n
    # pairs of chunks that are only in texts taken whole are in no document
    links, pairs, seen = (np.cumsum(seen > 0) - 1)[links], pairs[seen > 0], seen[seen > 0]
    return (ids, numbers.astype("<u4").tobytes(), b"".join(hashes), links.astype(link_kind(len(pairs))).tobytes(),
            pairs.astype("<u8").tobytes(), seen.astype("<u4").tobytes())


def link_kind(pairs: int) -> str:
    return "<u2" if pairs <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The documents encoded and aligned, in blocks."""
    schema = _arrow_schema(docs.sparkSession, BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabularies(*paths)
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            of = (np.cumsum(sizes, dtype=np.int64) - sizes) // BLOCK_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for m, n in zip(cuts, cuts[1:], strict=False):
                if n > m:
                    row = block(words, batch.column(0).slice(m, n - m).to_pylist(), batch.column(1).slice(m, n - m).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)
        free_memory()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def distinct_pairs(blocks: DataFrame) -> DataFrame:
    """(pair) of the blocks, gathered by each task first."""
    schema = _arrow_schema(blocks.sparkSession, "pair long")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, "<i8")
        for b in batches:
            for data in b.column(0).to_pylist():
                known = np.union1d(known, np.frombuffer(data, "<i8"))
                if len(known) >= SENT:
                    yield pa.RecordBatch.from_arrays([pa.array(known)], schema=schema)
                    known = known[:0]
        yield pa.RecordBatch.from_arrays([pa.array(known)], schema=schema)

    return blocks.select("pairs").mapInArrow(unpack, "pair long").distinct()


def perfect_hash(pairs: DataFrame, n: int) -> PerfectHash:
    """Of a shard of n pairs: buckets are built in tasks, only their bitmaps and
    keys reach the driver."""
    buckets = max(1, math.ceil(n / BUCKET_PAIRS))
    schema = "bucket int, level int, bits int, bitmap binary, keys binary"

    def build(rows: pa.Table) -> pa.Table:
        made = build_bucket(rows.column("pair").to_numpy().view(np.uint64))
        bucket = rows.column("bucket")[0].as_py()
        return pa.table({"bucket": pa.array([bucket] * len(made), pa.int32()),
                         "level": pa.array(range(len(made)), pa.int32()),
                         **{name: pa.array([m[k] for m in made], kind) for k, (name, kind) in enumerate(
                             (("bits", pa.int32()), ("bitmap", pa.binary()), ("keys", pa.binary())))}})

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = bucket_of(b.column(0).to_numpy().view(np.uint64), buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own)], names=["pair", "bucket"])

    rows = (pairs.mapInArrow(bucket, "pair long, bucket int").groupBy("bucket")
            .applyInArrow(build, schema).collect())
    return PerfectHash([tuple(r) for r in rows], buckets)


def count_documents(blocks: DataFrame, shared, n: int) -> np.ndarray:
    """Documents per slot: dense vectors of the tasks, summed as a tree."""
    schema_text = "stretch int, task int, counts binary"
    schema = _arrow_schema(blocks.sparkSession, schema_text)

    def batch(stretch: int, task: int, counts: np.ndarray) -> pa.RecordBatch:
        data = zlib.compress(counts.astype("<i8").tobytes(), 1)
        return pa.RecordBatch.from_arrays(
            [pa.array([stretch], pa.int32()), pa.array([task], pa.int32()), pa.array([data])], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots_of, total = shared.value, np.zeros(n, np.int64)
        for b in batches:
            for pairs, seen in zip(*(c.to_pylist() for c in b.columns), strict=True):
                slot = slots_of.slots(np.frombuffer(pairs, "<u8"))
                total[slot[slot >= 0]] += np.frombuffer(seen, "<u4")[slot >= 0]
        if total.any():
            for k in range(0, n, STRETCH):
                yield batch(k // STRETCH, TaskContext.get().partitionId(), total[k:k + STRETCH])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        task = 0
        for b in batches:
            for k, task, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = np.frombuffer(zlib.decompress(data), "<i8")
                sums[k] = sums[k] + own if k in sums else own
        for k, own in sums.items():
            yield batch(k, task, own)

    tree = blocks.select("pairs", "seen").mapInArrow(count, schema_text)
    # no task sums more stretches than the root of the number of tasks, or so
    fan = F.pmod("task", F.lit(max(1, math.isqrt(blocks.sparkSession.sparkContext.defaultParallelism))))
    tree = tree.repartition("stretch", fan).mapInArrow(add, schema_text)
    rows = tree.repartition("stretch").mapInArrow(add, schema_text).collect()
    total = np.zeros(n, np.int64)
    for r in rows:
        total[r.stretch * STRETCH:(r.stretch + 1) * STRETCH] = np.frombuffer(zlib.decompress(r.counts), "<i8")
    return total


def look_up(blocks: DataFrame, shared, counts) -> DataFrame:
    """The result rows, n_best and count_sum over the links of one shard."""
    schema = _arrow_schema(blocks.sparkSession, RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots_of, (count, best) = shared.value, counts.value
        for b in batches:
            for k, (numbers, hashes, links, pairs) in enumerate(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)):
                numbers = np.frombuffer(numbers, "<u4").reshape(4, -1).astype(np.int64)
                slot = slots_of.slots(np.frombuffer(pairs, "<u8"))
                of = np.zeros((2, len(slot)), np.int64)
                of[:, slot >= 0] = best[slot[slot >= 0]], count[slot[slot >= 0]]
                of = sums(of[:, np.frombuffer(links, link_kind(len(slot)))], numbers[3])
                hashes = [hashes[32 * i:32 * i + 32].hex() if n else "" for i, n in enumerate(numbers[0].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[k].values, *map(pa.array, (*numbers, *of)), pa.array(hashes)], schema=schema)

    return blocks.select("doc_ids", "numbers", "hashes", "links", "pairs").mapInArrow(run, RESULT)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``, with the columns of ``RESULT``.

    A text behind a space is encoded by the byte-level vocabulary A and, with
    the space that it adds itself, by the piece vocabulary B; special tokens in
    texts are plain text. Texts that are null or empty, or whose tokens' bytes
    are not those of the space and the text, have no tokens: zeros and ''.
    Repeated rows are documents of their own, null ids stay null, other columns
    are not read, an empty table gives no rows.
    """
    spark = docs.sparkSession
    paths = (a_path or public_tokenizers.path(BYTE_BPE), b_path or public_tokenizers.path(PIECE_BPE))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = stored(encoded(own, paths), "encoded", compression="zstd")
    pairs = stored(distinct_pairs(blocks), "id-pairs")
    n = pairs.count()
    shards = max(1, math.ceil(n / PAIRS_AT_ONCE))
    shard = F.pmod(F.xxhash64(F.shiftright("pair", 32)), F.lit(shards))
    found = None
    for k in range(shards):
        part = pairs.filter(shard == k)
        hashed = perfect_hash(part, n if shards == 1 else part.count())
        shared = spark.sparkContext.broadcast(hashed)
        count = count_documents(blocks, shared, len(hashed))
        a_id = (hashed.keys >> np.uint64(32)).astype(np.int64)
        most = np.zeros(a_id.max(initial=-1) + 1, np.int64)
        np.maximum.at(most, a_id, count)
        counts = spark.sparkContext.broadcast((count, count == most[a_id]))
        rows = look_up(blocks, shared, counts)
        if shards == 1:
            return rows
        found = stored(rows, "alignment") if found is None else found.union(stored(rows, "alignment"))
        shared.destroy()
        counts.destroy()
    # rows that are equal in all that does not depend on the shard have equal sums, too
    names = found.columns
    same = [c for c in names if c not in ("n_best", "count_sum")]
    copies = (F.col("rows") / shards).cast("long")
    return (found.groupBy(*same).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"),
                                     F.count("*").alias("rows"))
            .select(*same, *[(F.col(c) / copies).cast("long").alias(c) for c in ("n_best", "count_sum")],
                    F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select(*names))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))
