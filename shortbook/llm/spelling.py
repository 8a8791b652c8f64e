"""Groups of spelling variants by asymmetric q-chunks.

Words are counted over all documents. Two words are near if one inserted,
deleted or replaced code point makes one into the other. The longer word (or
the later of two equally long ones) gives two disjoint chunks, its halves; the
other word gives its positional grams of those lengths. One edit leaves a chunk
whole and moves it by one place at most, so near words meet in a chunk and a
gram that start within one place of each other; their distance is then
verified.

A chunk that too many words share is not joined on. What is left of both words
without it again differs by one edit, so the rest is cut in two in its turn,
and the words meet in the chunk and the part of the rest. A rest of one code
point ends this: then all that meet are as many as there are letters.

Spark sizes a table by its compressed files, and what is exploded from it as if
it had no more rows, so a few MB of words would be broadcast as a row for every
gram. Tables that grow with the words are therefore joined by sorting.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import _arrow_schema, stored, table

MIN_LENGTH, MIN_COUNT = 5, 3
# a run loses a letter where this divides the crc32 of "<doc_id>:<run>"
DROP_EVERY = 97
# a chunk with more pairs than this is cut further
MOST_PAIRS = 1_024
# keys to cut further are broadcast up to this number (some 100 bytes each)
MOST_KEYS = 100_000
# words counted in a task before their partial counts go out, and words looked up at once
MEMO_WORDS, RUNS_AT_ONCE = 400_000, 200_000

# letters of Latin-1, lower-cased in A-Z only: other characters are no letters, so "?" stands for them
RUN = re.compile(rb"[a-z\xc0-\xff]+")
LONGEST = 64


def _utf8(run: bytes) -> bytes:
    return run if run.isascii() else run.decode("latin-1").encode()


def _crc_steps() -> np.ndarray:
    """The table of crc32: what a byte shifted out of the register leaves."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_STEPS = _crc_steps()


def shifted(crc: np.ndarray, most: int) -> np.ndarray:
    """[k, l]: crc k moved on by l zero bytes. crc32 is affine, so the crc of a
    prefix and a run is the run's own xor the prefix's, moved by its bytes."""
    out = np.empty((len(crc), most + 1), np.uint32)
    out[:, 0] = crc
    for k in range(most):
        out[:, k + 1] = _STEPS[out[:, k] & 0xFF] ^ (out[:, k] >> np.uint32(8))
    return out


class RunCounter:
    """Counts of the words that documents' runs become, in bounded memory."""

    def __init__(self, drop_every: int = DROP_EVERY):
        self.drop_every = drop_every
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.crc = np.zeros(1 << 16, np.uint32)
        self.bytes = np.zeros(1 << 16, np.int32)
        self.count = np.zeros(1 << 16, np.int64)

    def _learn(self, runs: set[bytes]) -> None:
        for run in runs:
            k = self.number[run] = len(self.number)
            if k == len(self.crc):
                self.crc, self.bytes, self.count = (np.concatenate([a, np.zeros_like(a)])
                                                    for a in (self.crc, self.bytes, self.count))
            raw = _utf8(run)
            self.crc[k], self.bytes[k] = zlib.crc32(raw), min(len(raw), LONGEST + 1)

    def add(self, ids: list, texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """Count the runs of the texts; yields (words, counts) when the memo is full."""
        runs: list[bytes] = []
        sizes, prefixes = [], []
        for doc_id, text in zip(ids, texts, strict=True):
            own = RUN.findall(text.encode("latin-1", "replace").lower()) if text else []
            runs += own
            sizes.append(len(own))
            prefixes.append(("" if doc_id is None else str(doc_id)).encode() + b":")
            if len(runs) >= RUNS_AT_ONCE:
                self._count(runs, sizes, prefixes)
                runs, sizes, prefixes = [], [], []
                if len(self.number) >= MEMO_WORDS:
                    yield self.flush()
        if runs:
            self._count(runs, sizes, prefixes)

    def _count(self, runs: list[bytes], sizes: list[int], prefixes: list[bytes]) -> None:
        self._learn(set(runs).difference(self.number))
        code = np.fromiter(map(self.number.__getitem__, runs), np.int64, len(runs))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        moved = shifted(np.array([zlib.crc32(p) for p in prefixes], np.uint32), LONGEST)
        length = self.bytes[code]
        h = self.crc[code] ^ moved[doc, np.minimum(length, LONGEST)]
        for k in np.flatnonzero(length > LONGEST):
            h[k] = zlib.crc32(_utf8(runs[k]), zlib.crc32(prefixes[doc[k]]))
        gone = np.flatnonzero(h % np.uint32(self.drop_every) == 0)
        lost = []
        for k, at in zip(gone.tolist(), h[gone].tolist(), strict=True):
            run, place = runs[k], at % len(runs[k])
            lost.append(run[:place] + run[place + 1:])
        if lost:
            self._learn(set(lost).difference(self.number))
        kept = np.delete(code, gone)
        both = np.concatenate([kept, np.fromiter(map(self.number.__getitem__, lost), np.int64, len(lost))])
        self.count += np.bincount(both, minlength=len(self.count))

    def flush(self) -> tuple[list[bytes], np.ndarray]:
        words, counts = list(self.number), self.count[:len(self.number)]
        self._reset()
        return words, counts


def count_words(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points that occur
    at least ``min_count`` times. Tasks send sums of what they have read."""
    schema = _arrow_schema(docs.sparkSession, "word string, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = RunCounter()

        def out(words: list[bytes], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            keep = [k for k, w in enumerate(words) if len(w) >= min_length and counts[k]]
            for at in range(0, len(keep), 10_000):
                some = keep[at:at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[k].decode("latin-1") for k in some]), pa.array(counts[some])], schema=schema)

        for b in batches:
            for found in counter.add(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from out(*found)
        yield from out(*counter.flush())

    made = (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(count, "word string, n long"))
    return made.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _part(text: Column, at: Column, size: Column) -> Column:
    """``size`` code points from ``at`` (from 0) on."""
    return F.substring(text, at + 1, size)


def _chunks(words: DataFrame) -> DataFrame:
    """(key, word, n, rest): the two halves of every word as chunks, and the other half."""
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    first, second = _part(F.col("word"), F.lit(0), half), _part(F.col("word"), half, size - half)
    return _keyed(words.select("word", "n", F.explode(F.array(
        F.struct(size.alias("size"), F.lit(0).alias("side"), first.alias("chunk"), second.alias("rest")),
        F.struct(size.alias("size"), F.lit(1).alias("side"), second.alias("chunk"), first.alias("rest")))).alias("c")))


def _grams(words: DataFrame) -> DataFrame:
    """(key, word, n, rest): the positional grams of every word that are as
    long as a chunk of a word of its own length, or of one more, and start
    within one place of it. ``rest`` only where the gram stands as a
    whole chunk does when the other is edited; null elsewhere."""
    own = F.length("word")
    with_size = words.withColumn("size", F.explode(F.array(own, own + 1)))
    half = F.floor(F.col("size") / 2).cast("int")
    both = with_size.withColumn("c", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.lit(0).alias("at"), half.alias("q")),
        F.struct(F.lit(1).alias("side"), half.alias("at"), (F.col("size") - half).alias("q")))))
    q, at = F.col("c.q"), F.col("c.at")
    placed = both.withColumn("p", F.explode(F.sequence(
        F.greatest(at - 1, F.lit(0)), F.least(at + 1, own - q))))
    p = F.col("p")
    whole = F.when(F.col("c.side") == 0, p == 0).otherwise(p + q == own)
    rest = F.when(F.col("c.side") == 0, _part(F.col("word"), q, own - q)).otherwise(_part(F.col("word"), F.lit(0), p))
    return _keyed(placed.select("word", "n", F.struct(
        "size", F.col("c.side").alias("side"), _part(F.col("word"), p, q).alias("chunk"),
        F.when(whole, rest).alias("rest")).alias("c")))


def _keyed(rows: DataFrame) -> DataFrame:
    # keys are hashes: the distance of what meets is verified on the words
    return rows.select(F.xxhash64("c.size", "c.side", "c.chunk").alias("key"), "word", "n", F.col("c.rest").alias("rest"))


def _cut_chunks(rows: DataFrame) -> DataFrame:
    """Chunks whose key is cut further: the rest's two halves, with what is left of it."""
    size, half = F.length("rest"), F.floor(F.length("rest") / 2).cast("int")
    first, second = _part(F.col("rest"), F.lit(0), half), _part(F.col("rest"), half, size - half)
    return rows.select("word", "n", F.explode(F.array(
        F.struct(F.xxhash64("key", size, F.lit(0), first).alias("key"), second.alias("rest")),
        F.struct(F.xxhash64("key", size, F.lit(1), second).alias("key"), first.alias("rest")))).alias("c")) \
        .select("c.key", "word", "n", "c.rest")


def _cut_grams(rows: DataFrame) -> DataFrame:
    """The same of the grams: the other word's rest is as long, or longer by one."""
    own = F.length("rest")
    sized = rows.withColumn("size", F.explode(F.array(own, own + 1)))
    half = F.floor(F.col("size") / 2).cast("int")
    rest, left = F.col("rest"), F.col("size") - half
    first, second = _part(rest, F.lit(0), half), _part(rest, own - left, left)
    return sized.select("word", "n", F.explode(F.array(
        F.struct(F.xxhash64("key", "size", F.lit(0), first).alias("key"), _part(rest, half, own - half).alias("rest")),
        F.struct(F.xxhash64("key", "size", F.lit(1), second).alias("key"),
                 _part(rest, F.lit(0), own - left).alias("rest")))).alias("c")) \
        .select("c.key", "word", "n", "c.rest")


def _never_broadcast(right: DataFrame) -> DataFrame:
    """``right`` for a join that sorts both its sides, whatever their estimated sizes."""
    return right.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """(u, n_u, v, n_v): every two words of ``words`` (word, n; distinct words
    of two code points or more) at distance one, once."""
    chunks, grams, found = _chunks(words), _grams(words), None
    while True:
        keys = stored(chunks.select("key", F.lit(1).alias("a"), F.lit(0).alias("b"), F.length("rest").alias("left"))
                      .union(grams.select("key", F.lit(0), F.lit(1), F.lit(0)))
                      .groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("left").alias("left"))
                      .filter("a > 0 and b > 0 and (a > 1 or b > 1)"), "chunk-keys")
        hot = (F.col("a") * F.col("b") > MOST_PAIRS) & (F.col("left") > 1)
        few = keys.filter(~hot).select("key")
        u = chunks.select("key", F.col("word").alias("u"), F.col("n").alias("n_u"))
        v = grams.select("key", F.col("word").alias("v"), F.col("n").alias("n_v"))
        later = (F.length("u") > F.length("v")) | ((F.length("u") == F.length("v")) & (F.col("u") > F.col("v")))
        met = (u.join(_never_broadcast(few), "key").join(_never_broadcast(v), "key").filter(later)
               .filter(F.levenshtein("u", "v", 1) == 1).select("u", "n_u", "v", "n_v"))
        met = stored(met.distinct(), "near-words")
        found = met if found is None else found.union(met)
        many = keys.filter(hot).select("key")
        hot_keys = many.count()
        if not hot_keys:
            return found.distinct()
        many = F.broadcast(many) if hot_keys <= MOST_KEYS else _never_broadcast(many)
        chunks = stored(_cut_chunks(chunks.join(many, "key")), "cut-chunks")
        grams = stored(_cut_grams(grams.filter("rest is not null").join(many, "key")), "cut-grams")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    Words are the maximal runs of Latin-1 letters, lower-cased in A-Z, some
    with a letter dropped by rule (``DROP_EVERY``). A word's form is its near
    word of largest n, if that is at least twice the word's; the root is where
    the forms lead. A null text has no words, a null id counts as '', repeated
    rows count each time, other columns are not read, an empty table gives no
    rows. Runs of any length are words.
    """
    words = stored(count_words(docs, id_col, text_col, min_length, min_count), "words")
    pairs = stored(near_pairs(words), "near-pairs")
    best = (pairs.select(F.col("u").alias("word"), F.col("v").alias("near"), F.col("n_v").alias("m"))
            .union(pairs.select("v", "u", "n_u"))
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("m"), F.col("near"))).alias("b")))
    own = words.join(_never_broadcast(best), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("b.col1") >= 2 * F.col("n"), F.col("b.near")).alias("form"),
        F.when(-F.col("b.col1") >= 2 * F.col("n"), -F.col("b.col1")).alias("form_n"))
    own = stored(own, "forms")
    return own.join(_never_broadcast(_roots(own)), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(own: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. n at least doubles from a word to
    its form, so paths are short; each round doubles the steps taken."""
    now = own.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(now.join(_never_broadcast(on), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
