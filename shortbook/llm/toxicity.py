"""Toxicity scores from a bidirectional gated recurrent network.

A word enters the network as a word embedding (of the words that are in several
training texts; the others share one) next to two character inputs (mean
embeddings of its 3- and 5-character pieces, borders included, in hashed
buckets). Windows of ``WINDOW`` words, half overlapping, run through a GRU in
both directions; attention pools the states and one logistic unit scores the
window. A document's score is that of its worst window. The network is written
and trained in numpy, in one task, on a bounded sample of labelled rows; only
its parameters reach the driver. Scoring runs in Arrow batches on the executors
and covers every window.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import crc_mod, free_memory, map_rows, table, text_of

WINDOW, STRIDE = 24, 12
HIDDEN, EMBED, ATTENTION = 12, 8, 8
PIECE_BUCKETS = 1 << 14
# words in fewer training texts share one embedding; so many have one at most
WORD_TEXTS, MAX_WORDS = 4, 20_000
PIECES = (3, 5)
# the training sample: about so many labelled rows, none longer than this
SAMPLE_ROWS, SAMPLE_CHARS = 5_000, 12_000
THRESHOLD = 0.5
LETTERS = re.compile(r"[^\W\d_]+")
# windows scored at once, and words held at once while scoring
BLOCK, CHUNK_CHARS = 4_096, 1_000_000


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def piece_buckets(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per piece length: the buckets of the words' pieces, as (first entry of
    each word, buckets)."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lens)
    starts = ends - lens

    pieces = []
    for n in PIECES:
        count = np.maximum(lens - n + 1, 1)
        first = np.cumsum(count) - count
        at = np.repeat(starts - first, count) + np.arange(count.sum())
        last = np.repeat(ends, count)
        h = np.zeros(len(at), np.uint64)
        for k in range(n):
            inside = at + k < last
            code = codes[np.minimum(at + k, len(codes) - 1)] + np.uint64(7)
            h = h * np.uint64(0x100000001B3) + np.where(inside, code, np.uint64(0))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        pieces.append((first, (h >> np.uint64(40)).astype(np.int64) % PIECE_BUCKETS))
    return pieces


def window_starts(n_words: int) -> np.ndarray:
    """Half-overlapping windows that cover all words; one for an empty text."""
    if n_words <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n_words - WINDOW, STRIDE), n_words - WINDOW)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_parameters(rng: np.random.Generator, n_words: int) -> dict[str, np.ndarray]:
    d, h = EMBED * (1 + len(PIECES)), HIDDEN

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "word": normal(n_words + 1, EMBED, scale=0.1),
        **{f"piece{n}": normal(PIECE_BUCKETS, EMBED, scale=0.3) for n in PIECES},
        "wx": normal(2, d, 3 * h, scale=d**-0.5), "bx": np.zeros((2, 1, 3 * h), np.float32),
        "wh": normal(2, h, 3 * h, scale=h**-0.5),
        "wa": normal(2 * h, ATTENTION, scale=(2 * h) ** -0.5), "va": normal(ATTENTION, scale=0.5),
        "wo": normal(2 * h, scale=(2 * h) ** -0.5), "bo": np.zeros(1, np.float32),
    }


def inputs(p: dict, words: np.ndarray, pieces: list) -> np.ndarray:
    """Input vectors of words: the word embedding and mean piece embeddings."""
    parts = [p["word"][words]]
    for n, (first, buckets) in zip(PIECES, pieces, strict=True):
        count = np.diff(np.append(first, len(buckets)))[:, None].astype(np.float32)
        parts.append(np.add.reduceat(p[f"piece{n}"][buckets], first, axis=0) / count)
    return np.concatenate(parts, axis=1)


def forward(p: dict, projected: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logits of windows. ``projected``: (2, words + 1, 3h), the last row for
    padding; ``ids``: (windows, WINDOW) with the padding id behind the text."""
    n, steps = ids.shape
    h = HIDDEN
    pad = projected.shape[1] - 1
    live = (ids != pad)
    states = np.zeros((2, steps + 1, n, h), np.float32)
    saved = []
    for t in range(steps):
        now = np.stack([ids[:, t], ids[:, steps - 1 - t]])
        x = np.stack([projected[0][now[0]], projected[1][now[1]]])
        on = np.stack([live[:, t], live[:, steps - 1 - t]])[:, :, None]
        old = states[:, t]
        u = old @ p["wh"]
        gates = sigmoid(x[..., :2 * h] + u[..., :2 * h])
        z, r = gates[..., :h], gates[..., h:]
        c = np.tanh(x[..., 2 * h:] + r * u[..., 2 * h:])
        states[:, t + 1] = np.where(on, c + z * (old - c), old)
        if keep:
            saved.append((now, on, u[..., 2 * h:], z, r, c))
    both = np.concatenate([states[0, 1:], states[1, 1:][::-1]], axis=2)  # (steps, n, 2h)
    a = np.tanh(both @ p["wa"])
    e = np.where(live.T, a @ p["va"], np.float32(-1e9))
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[:, :, None] * both).sum(axis=0)
    logits = pooled @ p["wo"] + p["bo"][0]
    return (logits, (states, saved, both, a, w, pooled)) if keep else logits


def backward(p: dict, kept: tuple, dlogits: np.ndarray, n_words: int) -> dict:
    """Gradients of the sum of ``dlogits * logits``; 'projected' is that of
    the projected inputs, (2, words + 1, 3h)."""
    states, saved, both, a, w, pooled = kept
    h, steps = HIDDEN, len(saved)
    g = {"wo": pooled.T @ dlogits, "bo": np.array([dlogits.sum()], np.float32)}
    dpooled = dlogits[:, None] * p["wo"]
    dw = (both * dpooled).sum(axis=2)
    de = w * (dw - (w * dw).sum(axis=0))
    da = de[:, :, None] * p["va"] * (1 - a * a)
    g["va"] = (de[:, :, None] * a).sum(axis=(0, 1))
    g["wa"] = np.tensordot(both, da, axes=((0, 1), (0, 1)))
    dboth = w[:, :, None] * dpooled + da @ p["wa"].T
    out = np.stack([dboth[..., :h], dboth[..., h:][::-1]])  # by step of each direction
    g["wh"] = np.zeros_like(p["wh"])
    at, dxs = [], []
    dh = np.zeros_like(states[:, 0])
    for t in range(steps - 1, -1, -1):
        now, on, un, z, r, c = saved[t]
        old = states[:, t]
        dh = dh + out[:, t]
        dn = np.where(on, dh, 0)
        dc = dn * (1 - z) * (1 - c * c)
        dz = dn * (old - c) * z * (1 - z)
        dr = dc * un * r * (1 - r)
        dx = np.concatenate([dz, dr, dc], axis=2)
        du = np.concatenate([dz, dr, dc * r], axis=2)
        g["wh"] += old.transpose(0, 2, 1) @ du
        dh = np.where(on, dn * z, dh) + du @ p["wh"].transpose(0, 2, 1)
        at.append(now)
        dxs.append(dx)
    at, dxs = np.concatenate(at, axis=1), np.concatenate(dxs, axis=1)
    g["projected"] = np.stack([_sums(at[d], dxs[d], n_words) for d in (0, 1)])
    return g


def _sums(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, rows[:, k], n) for k in range(rows.shape[1])],
                    axis=1).astype(np.float32)


def _touched(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used, own = np.unique(index, return_inverse=True)
    return used, _sums(own, rows, len(used))


def project(p: dict, x: np.ndarray) -> np.ndarray:
    full = x @ p["wx"] + p["bx"]
    return np.concatenate([full, np.zeros_like(full[:, :1])], axis=1)


def gradients(p: dict, words: np.ndarray, pieces: list, ids: np.ndarray,
              y: np.ndarray) -> tuple[float, dict]:
    """Mean log loss of windows and its gradients; those of the embedding
    tables as (touched rows, gradients)."""
    x = inputs(p, words, pieces)
    logits, kept = forward(p, project(p, x), ids, keep=True)
    prob = sigmoid(logits)
    loss = -np.mean(np.where(y > 0, np.log(prob + 1e-9), np.log(1 - prob + 1e-9)))
    g = backward(p, kept, ((prob - y) / len(y)).astype(np.float32), len(words) + 1)
    dp = g.pop("projected")[:, :-1]
    g["bx"] = dp.sum(axis=1, keepdims=True)
    g["wx"] = x.T @ dp
    dx = (dp @ p["wx"].transpose(0, 2, 1)).sum(axis=0)
    g["word"] = _touched(words, dx[:, :EMBED])
    for k, (n, (first, buckets)) in enumerate(zip(PIECES, pieces, strict=True)):
        count = np.diff(np.append(first, len(buckets)))
        own = dx[:, EMBED * (k + 1):EMBED * (k + 2)] / count[:, None]
        g[f"piece{n}"] = _touched(buckets, np.repeat(own, count, axis=0))
    return float(loss), g


class Corpus:
    """Texts as word numbers, with each distinct word's inputs made once."""

    def __init__(self, texts: list[str | None], vocabulary: dict[str, int] | None = None):
        number: dict[str, int] = {}
        self.docs = []
        for t in texts:
            own = words_of(t)
            for w in own:
                number.setdefault(w, len(number))
            self.docs.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
        self.words = list(number) or [""]
        self.pad = len(self.words)
        self.pieces = piece_buckets(self.words)
        self.vocabulary = self.common() if vocabulary is None else vocabulary
        self.rows = np.array([self.vocabulary.get(w, 0) for w in self.words])

    def common(self) -> dict[str, int]:
        """Rows 1.. for the words that are in several texts, commonest first."""
        texts = np.bincount(np.concatenate([np.unique(d) for d in self.docs]),
                            minlength=len(self.words))
        best = np.argsort(-texts, kind="stable")[:MAX_WORDS]
        return {self.words[i]: k + 1 for k, i in enumerate(best) if texts[i] >= WORD_TEXTS}

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(windows, WINDOW) word numbers, and the document of each window."""
        starts = [window_starts(len(d)) for d in self.docs]
        owner = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
        flat = np.concatenate([*self.docs, np.full(WINDOW, self.pad)])
        base = np.cumsum([0, *[len(d) for d in self.docs]])
        at = np.concatenate([base[i] + s for i, s in enumerate(starts)])
        ids = flat[np.minimum(at[:, None] + np.arange(WINDOW), len(flat) - 1)]
        inside = at[:, None] + np.arange(WINDOW) < base[owner + 1][:, None]
        return np.where(inside, ids, self.pad), owner

    def logits(self, p: dict, ids: np.ndarray) -> np.ndarray:
        projected = project(p, inputs(p, self.rows, self.pieces))
        return np.concatenate([forward(p, projected, ids[k:k + BLOCK])
                               for k in range(0, len(ids), BLOCK)])

    def batch(self, ids: np.ndarray) -> tuple:
        """The batch's own words and its windows in their numbers."""
        used, own = np.unique(np.append(ids.ravel(), self.pad), return_inverse=True)
        used = used[:-1]
        pieces = []
        for first, buckets in self.pieces:
            count = np.diff(np.append(first, len(buckets)))[used]
            begin = np.cumsum(count) - count
            at = np.repeat(first[used] - begin, count) + np.arange(count.sum())
            pieces.append((begin, buckets[at]))
        return self.rows[used], pieces, own[:-1].reshape(ids.shape)


def fit(texts: list[str], labels: np.ndarray, epochs: int = 6, warm: int = 2, batch: int = 256,
        rate: float = 0.004, seed: int = 5) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """Parameters and vocabulary, by Adam on windows. The first ``warm`` epochs
    give windows their document's label; later ones use the worst windows of
    each document, and some random windows of those labelled 0."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        p = new_parameters(rng, 0)
        share = (labels.sum() + 1) / (len(labels) + 2)
        p["wo"][:] = 0
        p["bo"][:] = np.log(share / (1 - share))
        return p, {}
    corpus = Corpus(texts)
    p = new_parameters(rng, len(corpus.vocabulary))
    ids, owner = corpus.windows()
    y = labels[owner]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        draw = rng.random(len(ids))
        if epoch < warm:
            chosen = np.flatnonzero(draw < np.where(y > 0, 0.5, 0.1))
        else:
            logits = corpus.logits(p, ids)
            order = np.lexsort((-logits, owner))
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids)) - np.searchsorted(owner[order], owner[order])
            # the worst window of each; further ones of label 1 only if they look toxic too
            chosen = np.flatnonzero((rank == 0) | (y > 0) & (rank < 3) & (logits > 0)
                                    | (y == 0) & ((rank < 3) | (draw < 0.03)))
        rng.shuffle(chosen)
        size = min(batch, max(16, len(chosen) // 60))
        for k in range(0, len(chosen), size):
            rows = chosen[k:k + size]
            words, pieces, own = corpus.batch(ids[rows])
            _, g = gradients(p, words, pieces, own, y[rows])
            step += 1
            lr = rate * (0.4 if epoch >= epochs - 2 else 1) * min(1, step / 50)
            lr *= np.sqrt(1 - 0.99**min(step, 2000)) / (1 - 0.9**min(step, 2000))
            for name, x in g.items():
                at, x = x if isinstance(x, tuple) else (slice(None), x)
                first[name][at] = m = first[name][at] * 0.9 + 0.1 * x
                second[name][at] = v = second[name][at] * 0.99 + 0.01 * x * x
                p[name][at] -= lr * m / (np.sqrt(v) + 1e-7)
    return p, corpus.vocabulary


def score_texts(model: tuple[dict, dict], texts: list[str | None]) -> np.ndarray:
    """The worst window's probability; texts without a letter get 0."""
    p, vocabulary = model
    out = np.zeros(len(texts))
    k = 0
    while k < len(texts):
        n, chars = k, 0
        while n < len(texts) and (n == k or chars < CHUNK_CHARS):
            chars += len(texts[n] or "")
            n += 1
        corpus = Corpus(texts[k:n], vocabulary)
        ids, owner = corpus.windows()
        worst = np.full(n - k, -np.inf)
        np.maximum.at(worst, owner, corpus.logits(p, ids))
        some = np.array([len(d) > 0 for d in corpus.docs])
        out[k:n] = np.where(some, sigmoid(worst), 0.0)
        k = n
    return out


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5,
          sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> tuple[dict, dict]:
    """Fit on a hash sample of labelled rows whose crc32(doc_id) mod ``folds``
    is not 0. About ``sample_rows`` rows of at most ``sample_chars``
    characters go to the one task that trains; a third of them, if there are
    so many, have label 1."""
    usable = labels.select(F.col("doc_id").cast("long").alias("l_id"),
                           F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("label").isin(0, 1) & (crc_mod(F.col("l_id"), folds) != 0))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {1: sample_rows / 3 / max(counts.get(1, 0), 1),
             0: sample_rows * 2 / 3 / max(counts.get(0, 0), 1)}
    drawn = F.pmod(F.xxhash64("l_id", F.lit(23)), F.lit(1_000_000))
    chosen = usable.filter(F.when(F.col("label") == 1, drawn < int(min(1, share[1]) * 1_000_000))
                           .otherwise(drawn < int(min(1, share[0]) * 1_000_000)))
    most = max(share.values(), default=0)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text")) \
        .filter((F.length("text") <= sample_chars)
                & (F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1_000_000)) < int(min(1, most) * 1_000_000)))

    def learn(sample: pa.Table) -> pa.Table:
        sample = sample.sort_by([(c, "ascending") for c in ("doc_id", "label", "text")])
        model = fit(sample.column("text").to_pylist(), sample.column("label").to_numpy())
        free_memory()
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    made = (own.join(chosen, F.col("doc_id") == F.col("l_id"))
            .select("doc_id", "label", "text", F.lit(0).alias("all"))
            .groupBy("all").applyInArrow(learn, "model binary").first())
    return pickle.loads(made["model"]) if made else fit([], np.zeros(0))


def score(docs: DataFrame, model: tuple[dict, dict], folds: int = 5,
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document, repeated rows included. A null text, an empty one
    and one without letters score 0; a null id counts as '' for the fold;
    columns other than doc_id and text are not read; an empty table gives no
    rows. The parameters (2 MB at most, whatever the data) go to the executors
    once as a broadcast variable."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"],
                "score": score_texts(shared.value, cols["text"]).tolist()}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       text_of(F.col("text")).alias("text"))
    rows = rows.withColumn("held_out", crc_mod(F.col("doc_id"), folds) == 0)
    return map_rows(rows, scan, "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: tuple[dict, dict], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = score_texts(shared.value, b.column(b.schema.get_field_index("text")).to_pylist())
            yield b.filter(pa.array(scores < threshold))
        free_memory()

    return docs.mapInArrow(keep, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
