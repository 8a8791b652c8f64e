"""Language identification of words in code-switched text.

A linear-chain conditional random field labels every word of a text with a
language. A word's emission scores come from its prefixes and suffixes, its
character n-grams and a lexicon of words that one language uses; transitions
between the languages of neighbouring words are learned. Forward-backward
gives each word's posterior. A document's language is the one with the most
posterior mass over its letters, and its score is that share.

The field is trained in numpy on a bounded sample: runs of words from sampled
documents are strung together into code-switched sequences.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import crc_mod, map_rows, table

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
AFFIXES, NGRAMS = (1, 2, 3, 4), (1, 2, 3, 4)
# the training sample: about so many documents a language, none longer, and about so many in all
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_ALL = 500, 12_000, 20_000
# training sequences: so many, of runs of words from different documents
SEQUENCES, SEQUENCE_WORDS, RUN_WORDS = 2_500, 64, (4, 40)
# a word is in the lexicon when several texts and almost only one language have it
LEXICON_TEXTS, LEXICON_SHARE = 2, 0.9
UNKNOWN = "und"
CHUNK_CHARS = 1_000_000
SEGMENT = 128


def words_of(text: str) -> list[str]:
    """The words in lower case; a letter that becomes two stays in its word."""
    low = text.lower()
    return WORD.findall(low) if len(low) == len(text) else [w.lower() for w in WORD.findall(text)]


def char_features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words' affixes and n-grams, one (first entry of each
    word, buckets) per template. The word list is not empty, nor is a word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens)
    starts = ends - lens

    def buckets(at: np.ndarray, last: np.ndarray, n: int, tag: int) -> np.ndarray:
        h = np.full(len(at), tag + 1, np.uint64)
        for k in range(n):
            code = codes[np.minimum(at + k, len(codes) - 1)] + np.uint64(7)
            h = h * np.uint64(0x100000001B3) + np.where(at + k < last, code, np.uint64(0))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(40)).astype(np.int64) % BUCKETS

    one = np.arange(len(words))
    out = []
    for n in AFFIXES:
        out.append((one, buckets(starts, ends, n, 10 + n)))
        out.append((one, buckets(np.maximum(starts, ends - n), ends, n, 20 + n)))
    for n in NGRAMS:
        count = np.maximum(lens - n + 1, 1)
        first = np.cumsum(count) - count
        at = np.repeat(starts - first, count) + np.arange(count.sum())
        out.append((first, buckets(at, np.repeat(ends, count), n, 30 + n)))
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    features: np.ndarray  # (BUCKETS, L)
    lexicon: dict[str, int]  # word -> 1 + its language
    lexical: np.ndarray  # (L + 1, L), row 0 for words outside the lexicon
    transitions: np.ndarray  # (L, L), from row to column
    start: np.ndarray  # (L,)

    def emissions(self, words: list[str]) -> np.ndarray:
        total = self.lexical[[self.lexicon.get(w, 0) for w in words]].astype(np.float64)
        for first, buckets in char_features(words):
            total += mean_rows(self.features, first, buckets)
        return total


def mean_rows(rows: np.ndarray, first: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    count = np.diff(np.append(first, len(buckets)))[:, None]
    return np.add.reduceat(rows[buckets], first, axis=0) / count


def posteriors(model: LanguageModel, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Forward-backward over many sequences at once.

    ``scores``: emission scores of all words, one sequence behind the other;
    ``first``: True where a sequence begins. All sequences form one chain in
    which a first word forgets what is before it. The chain is cut into
    segments whose transfer matrices are multiplied side by side, so the work
    is vectorised whatever the lengths are. One matrix a segment is held, and
    one a segment is made at each step."""
    n, k = scores.shape
    size = -(-n // SEGMENT)
    e = np.ones((size * SEGMENT, k))
    e[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    begin = np.zeros(size * SEGMENT, bool)
    begin[:n] = first
    begin[n:] = True
    e, begin = e.reshape(size, SEGMENT, k), begin.reshape(size, SEGMENT)
    inside = np.exp(model.transitions - model.transitions.max())
    entry = np.exp(model.start - model.start.max())
    fresh = np.broadcast_to(entry, (k, k))

    def step(t: int) -> np.ndarray:
        m = np.where(begin[:, t, None, None], fresh, inside)
        return m * e[:, t, None, :]

    whole = np.broadcast_to(np.eye(k), (size, k, k))
    for t in range(SEGMENT):
        whole = whole @ step(t)
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    forward_in, backward_in = np.empty((size, k)), np.empty((size, k))
    v = np.full(k, 1 / k)
    for b in range(size):
        forward_in[b] = v
        v = v @ whole[b]
        v /= v.sum()
    v = np.ones(k)
    for b in range(size - 1, -1, -1):
        backward_in[b] = v
        v = whole[b] @ v
        v /= v.sum()
    post = np.empty_like(e)
    a = forward_in
    for t in range(SEGMENT):
        a = (a[:, None, :] @ step(t))[:, 0]
        a /= a.sum(axis=1, keepdims=True)
        post[:, t] = a
    z = backward_in
    for t in range(SEGMENT - 1, -1, -1):
        post[:, t] *= z
        z = (step(t) @ z[:, :, None])[:, :, 0]
        z /= z.sum(axis=1, keepdims=True)
    post = post.reshape(-1, k)[:n]
    post /= post.sum(axis=1, keepdims=True)
    return post


def _batch_gradient(model: LanguageModel, scores: np.ndarray, y: np.ndarray):
    """Log likelihood and gradients for (B, T, L) scores and (B, T) labels."""
    b, t, k = scores.shape
    shift = scores.max(axis=2, keepdims=True)
    e = np.exp(scores - shift)
    tr, st = np.exp(model.transitions), np.exp(model.start)
    alpha, scale = np.empty((b, t, k)), np.empty((b, t, 1))
    v = st * e[:, 0]
    for i in range(t):
        if i:
            v = (alpha[:, i - 1] @ tr) * e[:, i]
        scale[:, i] = v.sum(axis=1, keepdims=True)
        alpha[:, i] = v / scale[:, i]
    beta = np.ones((b, t, k))
    pair = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        right = e[:, i + 1] * beta[:, i + 1] / scale[:, i + 1]
        beta[:, i] = right @ tr.T
        pair += (alpha[:, i].T @ right) * tr
    post = alpha * beta
    gold = np.eye(k)[y]
    seen = np.zeros((k, k))
    np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    log_z = np.log(scale).sum() + shift.sum()
    log_p = (scores * gold).sum() + (model.transitions * seen).sum() + model.start[y[:, 0]].sum() - log_z
    return log_p, gold - post, seen - pair, (gold[:, 0] - post[:, 0]).sum(axis=0)


def fit(texts: list[str], langs: list[str], epochs: int = 4, batch: int = 32,
        rate: float = 0.05, seed: int = 3) -> LanguageModel:
    """Maximum likelihood by Adam on code-switched sequences."""
    rng = np.random.default_rng(seed)
    docs = [(words_of(t), lang) for t, lang in zip(texts, langs, strict=True)]
    docs = [(w, lang) for w, lang in docs if w]
    languages = sorted({lang for _, lang in docs})
    k = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    model = LanguageModel(languages, np.zeros((BUCKETS, k)), {}, np.zeros((k + 1, k)),
                          np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    seen: dict[str, np.ndarray] = {}
    for words, lang in docs:
        for w in set(words):
            seen.setdefault(w, np.zeros(k, np.int32))[number[lang]] += 1
    model.lexicon = {w: int(c.argmax()) + 1 for w, c in seen.items()
                     if c.sum() >= LEXICON_TEXTS and c.max() >= LEXICON_SHARE * c.sum()}
    by = [[w for w, lang in docs if number[lang] == i] for i in range(k)]
    ids, vocabulary = [], {}
    labels = np.empty((SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(SEQUENCES):
        words: list[str] = []
        where: list[int] = []
        stay = rng.random() < 0.5  # half of the sequences are in one language
        lang = int(rng.integers(k))
        while len(words) < SEQUENCE_WORDS:
            own = by[lang][rng.integers(len(by[lang]))]
            n = int(rng.integers(*RUN_WORDS))
            at = int(rng.integers(max(1, len(own) - n + 1)))
            run = own[at:at + n]
            words += run
            where += [lang] * len(run)
            if not stay:
                lang = int(rng.integers(k))
        labels[s] = where[:SEQUENCE_WORDS]
        ids.append([vocabulary.setdefault(w, len(vocabulary)) for w in words[:SEQUENCE_WORDS]])
    ids = np.array(ids)
    names = list(vocabulary)
    templates = char_features(names)
    lexical = np.array([model.lexicon.get(w, 0) for w in names])
    parts = {"features": model.features, "lexical": model.lexical,
             "transitions": model.transitions, "start": model.start}
    first, second = ({n: np.zeros_like(v) for n, v in parts.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(SEQUENCES)
        for b in range(0, SEQUENCES, batch):
            rows = order[b:b + batch]
            used, own = np.unique(ids[rows], return_inverse=True)
            # some lexicon hits are hidden, so that unknown words are met
            lex = np.where(rng.random(len(used)) < 0.3, 0, lexical[used])
            scores = model.lexical[lex].copy()
            entries = []
            for begin, buckets in templates:
                count = np.diff(np.append(begin, len(buckets)))[used]
                start = np.cumsum(count) - count
                at = buckets[np.repeat(begin[used] - start, count) + np.arange(count.sum())]
                entries.append((count, at))
                scores += mean_rows(model.features, start, at)
            _, gs, gt, g0 = _batch_gradient(model, scores[own].reshape(*rows.shape, SEQUENCE_WORDS, k),
                                            labels[rows])
            flat = gs.reshape(-1, k)
            own = own.ravel()
            per_word = np.stack([np.bincount(own, flat[:, j], len(used)) for j in range(k)], axis=1)
            where = np.concatenate([at for _, at in entries])
            share = np.concatenate([np.repeat(per_word / c[:, None], c, axis=0) for c, _ in entries])
            touched, at = np.unique(where, return_inverse=True)
            grads = {
                "features": (touched, np.stack([np.bincount(at, share[:, j], len(touched))
                                                for j in range(k)], axis=1)),
                "lexical": (slice(None), np.stack([np.bincount(lex, per_word[:, j], k + 1)
                                                   for j in range(k)], axis=1)),
                "transitions": (slice(None), gt), "start": (slice(None), g0),
            }
            step += 1
            lr = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for name, (at, g) in grads.items():
                g = g / (len(rows) * SEQUENCE_WORDS) - 1e-6 * parts[name][at]
                first[name][at] = m = 0.9 * first[name][at] + 0.1 * g
                second[name][at] = v = 0.99 * second[name][at] + 0.01 * g * g
                parts[name][at] += lr * m / (np.sqrt(v) + 1e-8)
    model.features = model.features.astype(np.float32)
    return model


def label_texts(model: LanguageModel, texts: list[str | None], spans: bool = False):
    """(languages, scores, spans) of texts; spans are (start, end, language)
    runs of equally labelled words in code points."""
    names, shares, runs = [], [], []
    k = 0
    while k < len(texts):
        n, chars = k, 0
        while n < len(texts) and (n == k or chars < CHUNK_CHARS):
            chars += len(texts[n] or "")
            n += 1
        _label_chunk(model, texts[k:n], spans, names, shares, runs)
        k = n
    return names, shares, runs


def _label_chunk(model, texts, spans, names, shares, runs) -> None:
    number: dict[str, int] = {}
    docs = []
    for t in texts:
        own = words_of(t or "")
        for w in own:
            number.setdefault(w, len(number))
        docs.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
    sizes = np.array([len(d) for d in docs])
    ends = np.cumsum(sizes)
    if len(model.languages) and ends[-1]:
        words = list(number)
        ids = np.concatenate(docs)
        first = np.zeros(len(ids), bool)
        first[(ends - sizes)[sizes > 0]] = True
        post = posteriors(model, model.emissions(words)[ids], first)
        # in place: the best language of a word stays the best
        post *= np.fromiter(map(len, words), np.float64, len(words))[ids][:, None]
        total = np.zeros((len(sizes), post.shape[1]))
        total[sizes > 0] = np.add.reduceat(post, (ends - sizes)[sizes > 0], axis=0)
    for i, t in enumerate(texts):
        if not len(model.languages) or not sizes[i] or not any(c.isalpha() for c in t):
            names.append(UNKNOWN)
            shares.append(0.0)
            runs.append([])
            continue
        best = int(total[i].argmax())
        names.append(model.languages[best])
        shares.append(float(np.clip(total[i][best] / total[i].sum(), 0, 1)))
        runs.append(_runs(model, t, post[ends[i] - sizes[i]:ends[i]].argmax(axis=1)) if spans else [])


def _runs(model: LanguageModel, text: str, labels: np.ndarray) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for m, label in zip(WORD.finditer(text), labels, strict=True):
        lang = model.languages[label]
        if out and out[-1][2] == lang:
            out[-1] = (out[-1][0], m.end(), lang)
        else:
            out.append((m.start(), m.end(), lang))
    return out


def train(docs: DataFrame, folds: int = 3, held_out: int = 1, sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS, sample_all: int = SAMPLE_ALL) -> LanguageModel:
    """Fit on documents with a language whose crc32(doc_id) mod ``folds`` is
    not ``held_out``: a hash sample of about ``sample_docs`` documents of at
    most ``sample_chars`` characters a language reaches the driver; texts stay
    where they are read. A language that only has longer texts is learned from
    their beginnings. About ``sample_all`` documents are drawn at most: with
    more than sample_all / sample_docs languages each has fewer of them."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string"),
                         F.col("text").cast("string")) \
        .filter(F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), folds) != held_out))
    short = F.coalesce(F.length("text") <= sample_chars, F.lit(False))
    n_langs = usable.select("lang").distinct().count()
    sample_docs = min(sample_docs, sample_all / max(n_langs, 1))
    counts = usable.groupBy("lang").agg(F.count_if(short).alias("n_short"), F.count("text").alias("n"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1_000_000)) / 1_000_000
    rows = (usable.filter("text is not null").join(counts, "lang")
            .filter((short & (draw * F.col("n_short") < sample_docs))
                    | ((F.col("n_short") == 0) & (draw * F.col("n") < sample_docs)))
            .select("doc_id", "lang", F.substring("text", 1, sample_chars).alias("text"))
            .orderBy("doc_id", "lang", "text").select("lang", "text").toPandas())
    return fit(rows["text"].tolist(), rows["lang"].tolist())


def predict(docs: DataFrame, model: LanguageModel, folds: int = 3, held_out: int = 1,
            spans: bool = False) -> DataFrame:
    """One row per document, repeated rows included; with ``spans`` also its
    runs of words by language.

    A null text or one without a letter gives ``und`` with score 0, as does a
    model without languages. Only text enters a prediction; a null id counts
    as '' for the fold; other columns are not read; an empty table gives no
    rows. The model's size does not depend on the data (2 MB for four
    languages, and the lexicon of its bounded sample)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(cols: dict[str, list]) -> dict[str, list]:
        names, shares, runs = label_texts(shared.value, cols["text"], spans)
        out = {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": names, "score": shares}
        if spans:
            out["spans"] = [[{"start": a, "end": b, "lang": c} for a, b, c in r] for r in runs]
        return out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", crc_mod(F.col("doc_id"), folds) == held_out)
    return map_rows(rows, scan, "doc_id long, held_out boolean, lang_pred string, score double"
                    + ", spans array<struct<start: long, end: long, lang: string>>" * spans)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
