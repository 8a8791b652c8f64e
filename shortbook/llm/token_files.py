"""Token files of directly addressable codes.

A token file is a Parquet data set of blocks, so any store that Spark can
write holds it and a retried task replaces its own output. A block holds whole
documents: their ids and token counts, and one payload with the token ids as
directly addressable codes. Each id is split into 8-bit chunks; level k holds
the k-th chunk of all ids that have one, next to a bitmap that says whether the
id goes on, and a rank directory over that bitmap. Any token is read by as many
array accesses as its id has chunks; no block is decoded for it.

Payload, little-endian: "DAC1", u32 tokens, u32 levels, then per level
u32 chunks, the chunks, the bitmap in u64 words, and u32 ranks, one per eight
words (the set bits before them). The last level has neither bitmap nor ranks.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shortbook.llm.common import _arrow_schema, table, text_of
from shortbook.session import scratch_dir

MAGIC = b"DAC1"
WORDS_PER_RANK = 8
BLOCK_TOKENS = 1 << 18
MEMO_CHUNKS = 250_000
BLOCKS = ("shard int, block long, start long, n_tokens long, doc_ids array<long>, "
          "doc_tokens array<long>, payload binary")

# white space besides the space and the newline: such texts are encoded in one piece
OTHER_SPACE = re.compile(r"[^\S \n]")
# a run of Latin letters in front of something that is no letter, or else all up to the next space
CHUNK = re.compile(r"[ \n]*[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+(?=[\x00-@\[-`{-\x7F]|\Z)"
                   r"|[ \n]*[^ \n]+|[ \n]+")
WORD = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+\Z")


def encode_codes(ids: np.ndarray) -> bytes:
    parts, rest = [], np.asarray(ids, dtype=np.uint32)
    n, levels = len(rest), 0
    while True:
        more = rest > 255
        chunks = (rest & 255).astype(np.uint8).tobytes()
        last = not more.any()
        parts += [struct.pack("<I", len(rest)), chunks]
        levels += 1
        if last:
            break
        bits = np.zeros(-(-len(rest) // 64) * 64, np.uint8)
        bits[:len(rest)] = more
        bitmap = np.packbits(bits, bitorder="little")
        counts = np.add.reduceat(bits, np.arange(0, len(bits), 64 * WORDS_PER_RANK), dtype=np.int64)
        ranks = (np.cumsum(counts) - counts).astype("<u4")
        parts += [bitmap.tobytes(), ranks.tobytes()]
        rest = rest[more] >> 8
    return b"".join([MAGIC, struct.pack("<II", n, levels), *parts])


class Codes:
    """A payload, read in place."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.n, levels = struct.unpack_from("<II", payload, 4)
        at, self.levels = 12, []
        for k in range(levels):
            (count,) = struct.unpack_from("<I", payload, at)
            chunks = np.frombuffer(payload, np.uint8, count, at + 4)
            at += 4 + count
            bitmap = ranks = None
            if k < levels - 1:
                words = -(-count // 64)
                bitmap = np.frombuffer(payload, np.uint8, words * 8, at)
                at += words * 8
                ranks = np.frombuffer(payload, "<u4", -(-words // WORDS_PER_RANK), at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """Token ``i`` by one chunk and one rank per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            group = i // (64 * WORDS_PER_RANK)
            begin = group * 8 * WORDS_PER_RANK
            before = int.from_bytes(bitmap[begin:i >> 3].tobytes(), "little").bit_count()
            before += (int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(ranks[group]) + before
            shift += 8
        raise ValueError("the last level says that an id goes on")

    def all(self) -> np.ndarray:
        """Every id, by levels from the last."""
        value = None
        for chunks, bitmap, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if bitmap is not None:
                more = np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)
                own[more] |= value << np.uint32(8)
            value = own
        return value


@functools.cache
def tokenizer(path: str, special: bool = True):
    """The library's tokenizer; without ``special`` the strings of special
    tokens in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special
    return t


def byte_alphabet() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: a byte that
    prints is its Latin-1 character, the others follow from 256 on."""
    shown = [b for b in range(256) if b != 0x20 and chr(b).isprintable()]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """The tokenizer with a bounded memo of chunks.

    Its pattern never joins a white-space run to what stands before it, nor a
    letter to a following character that is no letter. So a text's ids are
    those of its chunks: runs of spaces and newlines with the letters or the
    rest of a word behind them. Chunks seen before are not encoded again. A
    chunk of letters behind one space at most is a single piece of the
    pattern, so it goes straight to the library's merges. Texts that hold an
    added token are encoded in one piece."""

    def __init__(self, path: str, special: bool = True):
        self.tokenizer = tokenizer(path, special)
        added = self.tokenizer.get_added_tokens_decoder().values()
        found = [re.escape(t.content) for t in added if special or not t.special]
        self.added = re.compile("|".join(found)) if found else None
        split = self.tokenizer.pre_tokenizer
        self.bytes = byte_alphabet() if (type(split).__name__ == "ByteLevel" and not split.add_prefix_space
                                         and self.tokenizer.normalizer is None) else None
        # chunks met since the last turn, and those met before it
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def raw(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, by the library alone."""
        return [struct.pack(f"<{len(e)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each encoded alone."""
        found: dict[str, bytes] = {}
        merge = self.tokenizer.model.tokenize
        for c in chunks:
            if self.bytes and WORD.match(c):
                ids = [t.id for t in merge(c.encode().decode("latin-1").translate(self.bytes))]
                found[c] = struct.pack(f"<{len(ids)}I", *ids)
        rest = [c for c in chunks if c not in found]
        found.update(zip(rest, self.raw(rest), strict=True))
        return [found[c] for c in chunks]

    def _learn(self, new: set[str]) -> None:
        memo, old = self.memo, self.old
        rest = [c for c in new if c not in old]
        memo.update((c, old[c]) for c in new if c in old)
        memo.update(zip(rest, self.chunk_ids(rest), strict=True))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian u32."""
        if OTHER_SPACE.search(text) or self.added and self.added.search(text):
            return self.raw([text])[0]
        chunks = CHUNK.findall(text)
        new = set(chunks).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_CHUNKS:
            self.memo, self.old = {}, self.memo
            new = set(chunks)
        if new:
            self._learn(new)
        return b"".join(map(self.memo.__getitem__, chunks))


@functools.cache
def encoder_of(path: str, special: bool = True) -> Encoder:
    """One encoder a worker process: the chunks that a task has met need not be
    encoded again by the next one. Its memo is bounded."""
    return Encoder(path, special)


def token_blocks(docs: DataFrame, order: list[Column], vocabulary: str | None = None,
                 end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks in ascending ``order``: shards are ranges of it, one per task
    (the order columns are numbers: a sample of them reaches the driver). A block ends with the document that fills it,
    so it is larger than ``block_tokens`` by one document at most."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    schema = _arrow_schema(docs.sparkSession, BLOCKS)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = encoder_of(path), TaskContext.get().partitionId()
        end = struct.pack("<I", end_id)
        start = number = held = 0
        ids, sizes, parts = [], [], []

        def flush() -> pa.RecordBatch:
            payload = encode_codes(np.frombuffer(b"".join(parts), "<u4"))
            row = [[shard], [number], [start], [held], [ids], [sizes], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = encoder.encode(text)
                ids.append(doc_id)
                sizes.append(len(raw) // 4 + 1)
                parts += [raw, end]
                held += sizes[-1]
                if held >= block_tokens:
                    yield flush()
                    start, number, held = start + held, number + 1, 0
                    ids, sizes, parts = [], [], []
        if ids:
            yield flush()

    keys = [c.asc_nulls_first() for c in order]
    # only id and text go to Python; other order columns end at the sort
    return (docs.repartitionByRange(*keys).sortWithinPartitions(*keys, "text").select("doc_id", "text")
            .mapInArrow(write, BLOCKS))


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 order: list[Column] | None = None, vocabulary: str | None = None) -> None:
    """Encode every document and write the blocks to ``path``.

    A null text is empty (its document is the end id alone), null ids come
    first, repeated ids and rows are each a document of their own, an empty
    table writes no block. Other columns of ``docs`` are not written."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      text_of(F.col(text_col)).alias("text"),
                      *[c.alias(f"by_{k}") for k, c in enumerate(order or [])])
    by = [F.col(f"by_{k}") for k in range(len(order or []))]
    token_blocks(own, by or [F.col("doc_id")], vocabulary).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``first``, the number of tokens in all blocks before."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # one row per shard, that is per writing task
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("in_shard"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("in_shard").over(before), F.lit(0)).alias("offset"))
    return (blocks.join(F.broadcast(offsets), "shard")
            .withColumn("first", F.col("offset") + F.col("start")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: start, token count and a crc32 of its ids."""
    out_schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema = _arrow_schema(spark, out_schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = Codes(row["payload"]).all().astype("<u4")
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes + row["first"]),
                     pa.array(sizes), pa.array(crc, pa.int64())], schema=schema)

    return (read_blocks(spark, path).select("first", "doc_ids", "doc_tokens", "payload")
            .mapInArrow(read, out_schema))


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """(position, token) for positions in the whole sequence, by direct access
    to the blocks that hold them; positions outside give no row."""
    schema = _arrow_schema(spark, "position long, token long")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                codes = Codes(row["payload"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["wanted"], pa.int64()),
                     pa.array([codes[p - row["first"]] for p in row["wanted"]], pa.int64())], schema=schema)

    wanted = F.filter(F.array(*[F.lit(int(p)).cast("long") for p in positions]),
                      lambda p: (p >= F.col("first")) & (p < F.col("first") + F.col("n_tokens")))
    return (read_blocks(spark, path).withColumn("wanted", wanted).filter(F.size("wanted") > 0)
            .select("first", "wanted", "payload").mapInArrow(pick, "position long, token long"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
