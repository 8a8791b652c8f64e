"""Secret scan by token efficiency.

Fixed patterns find assignments, access keys and long hex runs. On top of
them a token-efficiency test looks at every other long unbroken run of key
characters: a byte-pair vocabulary learnt on text needs few tokens for words
and many for random strings, so a low number of characters per token exposes
them. Known digests, UUIDs and plain numbers are excluded before the test, and
runs without a digit whose letters follow each other much as in the
vocabulary's words. A run that is not found is cut at its separators,
and its parts are tested by themselves, so words beside a key do not hide it.
"""

from __future__ import annotations

import base64
import bisect
import functools
import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import map_rows, table

# fixed patterns of the base scan; (kind, pattern, group to measure, least length)
BASE_PATTERNS = [
    ("assign", re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
# A run shorter than the least length never passes, and maximal runs do not
# depend on where the scan starts, so long runs can be matched directly.
FAST_PATTERNS = {"access": re.compile(r"AKIA[A-Z0-9]{16,}"), "hex": re.compile(r"[0-9a-f]{24,}")}

KINDS = ["assign", "access", "hex", "random"]
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
# a run is cut at the first of these, its parts at the next
SEPARATORS = [re.compile("=+"), re.compile("/+"), re.compile("[_+-]+")]
NAME_PART = re.compile(r"[A-Za-z]+")
MIN_RUN = 16

MAX_CHARS_PER_TOKEN = 2.1
# bits by which the letters of a run without a digit must speak against words:
# one long run of letters in 2**8 is taken to be a key
KEY_BITS = 8

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, n_random long, "
          "base_sha256 string, spans string")


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every base match, leftmost and
    non-overlapping within its kind."""
    spans = []
    for number, (kind, pattern, group, least) in enumerate(BASE_PATTERNS):
        for m in FAST_PATTERNS.get(kind, pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                spans.append((m.start(), number, m.end()))
    return sorted(spans)


def is_identifier(s: str) -> bool:
    """Digests of known lengths, UUIDs and numbers."""
    if len(s) in DIGEST_LENGTHS and DIGEST.match(s) or UUID.match(s):
        return True
    return not any(c.isalpha() for c in s)


@functools.cache
def letter_pairs(enc: tiktoken.Encoding) -> dict[str, float]:
    """log2 of how much likelier a letter follows another in the vocabulary's
    words than in random letters."""
    counts = np.full((26, 26), 0.5)
    for token in enc.token_byte_values():
        word = token.strip().lower()
        if word.isalpha() and word.isascii():
            letters = np.frombuffer(word, np.uint8) - ord("a")
            np.add.at(counts, (letters[:-1], letters[1:]), 1)
    gain = np.log2(26 * counts / counts.sum(axis=1, keepdims=True))
    return {chr(97 + a) + chr(97 + b): float(gain[a, b]) for a in range(26) for b in range(26)}


def is_random(s: str, enc: tiktoken.Encoding, max_ratio: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Few characters per token. In a run without a digit the separators count
    neither as characters nor as tokens: names of several words have many; and
    its letters must be less likely as a word's than as random ones."""
    if is_identifier(s):
        return False
    parts = [s] if any(c.isdigit() for c in s) else NAME_PART.findall(s)
    if sum(map(len, parts)) >= max_ratio * sum(len(enc.encode_ordinary(p)) for p in parts):
        return False
    if any(c.isdigit() for c in s):
        return True
    gain = letter_pairs(enc)
    return sum(gain[a + b] for p in parts for a, b in itertools.pairwise(p.lower())) <= -KEY_BITS


def random_spans(text: str, taken: list[tuple[int, int, int]], enc: tiktoken.Encoding,
                 max_ratio: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans whose characters per token are few;
    of other candidates, the longest such parts between separators."""
    spans = []
    starts, ends = [], []  # of the stretches that base spans cover
    for s, _, e in sorted(taken):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)

    def covered(s: int, e: int) -> bool:
        k = bisect.bisect_left(starts, e) - 1
        return k >= 0 and ends[k] > s

    def judge(s: int, e: int, level: int) -> None:
        if e - s < MIN_RUN:
            return
        if not covered(s, e) and is_random(text[s:e], enc, max_ratio):
            spans.append((s, 3, e))
            return
        for k in range(level, len(SEPARATORS)):
            cuts = [m.span() for m in SEPARATORS[k].finditer(text, s, e)]
            if cuts:
                for a, b in zip([s, *(b for _, b in cuts)], [*(a for a, _ in cuts), e], strict=True):
                    judge(a, b, k + 1)
                return

    for m in CANDIDATE.finditer(text):
        judge(*m.span(), 0)
    return spans


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None,
                 max_ratio: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document with its secret counts and spans.

    Spans are code-point offsets, end exclusive. A null or empty text has no
    spans (its hash is that of the empty string); repeated ids give one row
    each; other columns of ``docs`` are not read. ``vocabulary`` is a rank
    file in tiktoken's format, present on every executor.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def scan(cols: dict[str, list]) -> dict[str, list]:
        enc = encoding(path)
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_assign", "n_access", "n_hex",
                                                "n_random", "base_sha256", "spans")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            text = text or ""
            base = base_spans(text)
            extra = random_spans(text, base, enc, max_ratio)
            counts = [0, 0, 0]
            for _, k, _ in base:
                counts[k] += 1
            out["doc_id"].append(doc_id)
            for name, n in zip(("n_assign", "n_access", "n_hex"), counts, strict=True):
                out[name].append(n)
            out["n_random"].append(len(extra))
            out["base_sha256"].append(hashlib.sha256(join_spans(base).encode()).hexdigest())
            out["spans"].append(join_spans(base + extra))
        return out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, scan, SCHEMA)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
