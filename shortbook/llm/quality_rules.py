"""Quality rules: per-document base rules plus cross-document line frequency.

Lines are normalised and hashed, and the distinct documents of a host that
hold each line are counted (exact copies count once: telling copies apart is
not this operator's task). A line is above the limit when it is in more than
``min_docs`` documents and in more than ``max_share`` of the host's documents.
Such lines are removed, and a document of which less than ``min_left`` of the
words remains is rejected.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import WORD, map_rows, stored, table

WORDS = re.compile(WORD)
SYMBOLS = re.compile(r"[#*$%&|<>]+")
DIGITS = re.compile(r"[0-9]")
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_DOCS = 10
MAX_SHARE = 0.01
MIN_LEFT = 0.5

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    if len(words) <= window:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(number) == len(words):
        return 0
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.uint64, count=len(words))
    # a 64-bit mix of each word's number, then a polynomial over the window
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    n = len(words) - window + 1
    key = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        key = key * np.uint64(0x100000001B3) + mixed[k:k + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    steps[:n] += twice
    steps[window:window + n] -= twice
    return int(np.count_nonzero(np.cumsum(steps) > 0))


def normal_line(words: list[str]) -> str:
    """Words joined by one space, ASCII letters lower, every digit a 0."""
    return DIGITS.sub("0", " ".join(words).translate(ASCII_LOWER))


def measure(text: str) -> dict:
    words, hashes, counts = [], [], []
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        own = WORDS.findall(line)
        if own:
            dup += line in seen
            seen.add(line)
            words += own
            hashes.append(xxhash.xxh3_64_intdigest(normal_line(own)) - (1 << 63))
        else:
            hashes.append(None)
        counts.append(len(own))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(map(len, SYMBOLS.findall(text))), "n_dup_lines": dup,
        "n_repeat_words": repeated_words(words), "line_hash": hashes, "line_words": counts,
    }


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source", keep_text: bool = False, min_docs: int = MIN_DOCS,
               max_share: float = MAX_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """Base statistics, removed words and the verdict, one row per document;
    with ``keep_text`` also the text without the removed lines.

    A null text is empty (and fails the base rules), null hosts are one host,
    repeated ids and rows are judged each on its own, other columns of
    ``docs`` are not read, an empty table gives no rows.
    """
    keep = ["text"] if keep_text else []

    def scan(cols: dict[str, list]) -> dict[str, list]:
        found = [measure(t) for t in cols["text"]]
        out = {k: [m[k] for m in found] for k in (*_STATS, "line_hash", "line_words")}
        return out | {k: cols[k] for k in ("doc_id", "host", "copy", *keep)}

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("copy", F.xxhash64("text"))
    measured = map_rows(
        rows, scan,
        "doc_id long, host string, copy long, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, line_hash array<long>, line_words array<int>"
        + ", text string" * keep_text,
    ).withColumn("row", F.monotonically_increasing_id())
    measured = stored(measured, "line-rules")

    lines = measured.select(
        "row", "host", "copy",
        F.posexplode(F.arrays_zip("line_hash", "line_words")).alias("pos", "line"),
    ).select("row", "host", "copy", "pos", F.col("line.line_hash").alias("hash"),
             F.col("line.line_words").alias("words")).filter("hash is not null")
    hosts = (measured.groupBy("host", "copy").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count("*").alias("host_docs")))
    frequent = (lines.groupBy("host", "copy", "hash").agg(F.lit(1).alias("one"))
                .groupBy("host", "hash").agg(F.count("*").alias("n_docs"))
                .filter(F.col("n_docs") > min_docs)
                .join(hosts.withColumnRenamed("host", "of_host"),
                      F.col("host").eqNullSafe(F.col("of_host")))
                .filter(F.col("n_docs") > max_share * F.col("host_docs"))
                .select(F.col("host").alias("f_host"), F.col("hash").alias("f_hash")))
    frequent = stored(frequent, "frequent-lines")
    removed = (lines.join(frequent, (F.col("hash") == F.col("f_hash"))
                          & F.col("host").eqNullSafe(F.col("f_host")))
               .groupBy("row").agg(F.sum("words").alias("n_removed_words"),
                                   *([F.collect_list("pos").alias("gone")] if keep_text else [])))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    out = (measured.join(removed, "row", "left")
           .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
           .withColumn("base_failed", failed)
           .withColumn("kept", ~F.col("base_failed") & (
               F.col("n_words") - F.col("n_removed_words") >= min_left * F.col("n_words"))))
    if keep_text:
        out = out.withColumn("text", F.expr(
            "case when gone is null then text else concat_ws('\\n', "
            "filter(split(text, '\\n', -1), (x, i) -> not array_contains(gone, i))) end"))
    return out.select("doc_id", *_STATS, "n_removed_words", "base_failed", "kept", *keep)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), lines AS (
  SELECT r, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d
), worded AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         regexp_replace(translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS norm,
         row_number() OVER (PARTITION BY r, line ORDER BY pos) AS nth
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), hosts AS (
  SELECT source, count(DISTINCT text) AS host_docs FROM d GROUP BY source
), freq AS (
  SELECT l.source, norm FROM worded l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, norm, host_docs
  HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.01 * host_docs
), per_doc AS (
  SELECT r, count(*) FILTER (WHERE nth > 1) AS dup,
         coalesce(sum(n) FILTER (WHERE f.norm IS NOT NULL), 0) AS removed
  FROM worded l LEFT JOIN freq f ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source
  GROUP BY r
), starts AS (
  SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8
), wins AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(words, i, i + 7)) AS c FROM starts
), cover AS (
  SELECT r, count(DISTINCT p) AS n_rep
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM wins WHERE c > 1) GROUP BY r
), s AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words,
         coalesce(removed, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN per_doc p ON w.r = p.r LEFT JOIN cover c ON w.r = c.r
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s
)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 0.5 * n_words AS kept FROM b
"""
