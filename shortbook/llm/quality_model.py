"""Quality classifier: a sparse rule ensemble over text statistics.

The statistics are built-in column expressions over the whole text. On a
bounded sample of labelled rows, small boosted regression trees are grown, the
path to every node becomes a conjunctive rule, and a lasso logistic regression
keeps few of them. The kept rules are compiled back into one Spark column, so
scoring runs no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm.common import crc_mod, table, text_of

# expected number of labelled rows used for fitting
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3

STATISTICS = [
    "n_chars", "n_words", "n_lines", "word_length", "line_words", "distinct_words",
    "distinct_lines", "upper", "digits", "symbols", "pipes", "exclamations", "sentence_marks",
    "other_marks", "non_ascii",
]


def _removed(text: Column, pattern: str) -> Column:
    """Code points of ``text`` in the character class ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds ``STATISTICS`` to (doc_id, text); empty texts give zeros."""
    t = F.col("text")
    # arrays first, in a projection of their own: each is made once per row
    base = docs.withColumns({
        "words_": F.regexp_extract_all(t, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
        "lines_": F.split(t, "\n", -1),
        "n_chars": F.length(t).cast("double"),
    })
    n = F.greatest(F.col("n_chars"), F.lit(1.0))
    n_words = F.size("words_").cast("double")
    w = F.greatest(n_words, F.lit(1.0))
    n_lines = F.size("lines_").cast("double")
    visible = F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("double")

    return base.select(
        "doc_id", "n_chars", n_words.alias("n_words"), n_lines.alias("n_lines"),
        (visible / w).alias("word_length"), (n_words / n_lines).alias("line_words"),
        (F.size(F.array_distinct("words_")) / w).alias("distinct_words"),
        (F.size(F.array_distinct("lines_")) / n_lines).alias("distinct_lines"),
        (_removed(t, r"\p{Lu}+") / n).alias("upper"),
        (_removed(t, "[0-9]+") / n).alias("digits"),
        (_removed(t, "[#*$%&<>]+") / n).alias("symbols"),
        (_removed(t, r"\|+") / n).alias("pipes"),
        (_removed(t, "!+") / n).alias("exclamations"),
        (_removed(t, "[.,;:?]+") / n).alias("sentence_marks"),
        (_removed(t, r"[\"'()\[\]{}+=~^`@_/\\-]+") / n).alias("other_marks"),
        (_removed(t, r"[^\x00-\x7F]+") / n).alias("non_ascii"),
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # statistic > cut, else statistic <= cut
    cut: float


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    weight: float


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """The probability of label 1 as a column over the statistics."""
        z = F.lit(float(self.bias))
        for rule in self.rules:
            hit = F.lit(True)
            for c in rule.conditions:
                v = F.col(c.statistic)
                hit = hit & (v > c.cut if c.above else v <= c.cut)
            z = z + F.when(hit, F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule in self.rules:
            z += rule.weight * holds(x, rule.conditions)
        return 1 / (1 + np.exp(-z))


def holds(x: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    hit = np.ones(len(x), dtype=bool)
    for c in conditions:
        v = x[:, STATISTICS.index(c.statistic)]
        hit &= v > c.cut if c.above else v <= c.cut
    return hit


def _best_split(x: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray,
                cuts: list[np.ndarray], least: int):
    best = (1e-6, None)
    g, h = grad[rows].sum(), hess[rows].sum()
    for j, own in enumerate(cuts):
        if not len(own):
            continue
        slot = np.searchsorted(own, x[rows, j], side="left")  # x <= own[k] goes to slots 0..k
        gs = np.bincount(slot, grad[rows], len(own) + 1).cumsum()[:-1]
        hs = np.bincount(slot, hess[rows], len(own) + 1).cumsum()[:-1]
        ns = np.bincount(slot, minlength=len(own) + 1).cumsum()[:-1]
        ok = (ns >= least) & (len(rows) - ns >= least)
        gain = np.where(ok, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (j, float(own[k])))
    return best[1]


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 16, depth: int = 3,
               rate: float = 0.3, least: int = 8) -> list[tuple[Condition, ...]]:
    """Conditions on the path to every node of boosted trees, without repeats."""
    cuts = []
    for j in range(x.shape[1]):
        v = np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1], method="lower"))
        cuts.append(v[v < x[:, j].max()])
    z = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        grad, hess = y - p, p * (1 - p) + 1e-9
        open_nodes = [(np.arange(len(y)), ())]
        while open_nodes:
            rows, path = open_nodes.pop()
            split = _best_split(x, rows, grad, hess, cuts, least) if len(path) < depth else None
            if split is None:
                z[rows] += rate * grad[rows].sum() / (hess[rows].sum() + 1)
                continue
            j, cut = split
            low = x[rows, j] <= cut
            for side, own in ((False, rows[low]), (True, rows[~low])):
                longer = (*path, Condition(STATISTICS[j], side, cut))
                found[longer] = None
                open_nodes.append((own, longer))
    return list(found)


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float,
                   steps: int = 600) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the bias is not penalised."""
    n = len(y)
    scale = np.maximum(a.std(axis=0), 0.05)
    mean = a.mean(axis=0)
    s = (a - mean) / scale
    top = np.linalg.norm(s.T @ s / n, 2)
    rate = 1 / (0.25 * (top + 1))
    w, b = np.zeros(s.shape[1]), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(s @ vw + vb))) - y
        nw = vw - rate * (s.T @ r) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = vb - rate * r.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    w = w / scale
    return b - float(mean @ w), w


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 0.0004) -> RuleModel:
    """A constant model (the smoothed share of 1) when only one label is there."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))), ())
    rules = grow_rules(x, y)
    if not rules:
        share = y.mean()
        return RuleModel(float(np.log(share / (1 - share))), ())
    a = np.stack([holds(x, r) for r in rules], axis=1).astype(np.float64)
    bias, w = lasso_logistic(a, y, penalty)
    return RuleModel(float(bias), tuple(
        Rule(r, float(v)) for r, v in zip(rules, w, strict=True) if abs(v) > 1e-6))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, folds: int,
                    sample_rows: int) -> tuple[DataFrame, DataFrame]:
    """(documents, labels) of a hash sample of about ``sample_rows`` labelled
    rows outside the held-out fold; the fraction comes from a count of them."""
    usable = labels.select(F.col("doc_id").cast("long").alias("l_id"),
                           F.col(label_col).cast("int").alias("label")) \
        .filter(F.col("label").isin(0, 1) & (crc_mod(F.col("l_id"), folds) != 0))
    total = usable.count()
    limit = min(1_000_000, int(1_000_000 * sample_rows / max(total, 1)))
    chosen = lambda c: F.pmod(F.xxhash64(c, F.lit(17)), F.lit(1_000_000)) < limit
    return docs.filter(chosen(F.col("doc_id"))), usable.filter(chosen(F.col("l_id")))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5,
          sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on labelled rows whose crc32(doc_id) mod ``folds`` is not 0; the
    sample's expected size ``sample_rows`` bounds what reaches the driver."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      text_of(F.col("text")).alias("text"))
    some, usable = labelled_sample(own, labels, label_col, folds, sample_rows)
    rows = (with_statistics(some).join(usable, F.col("doc_id") == F.col("l_id"))
            .orderBy("doc_id", *STATISTICS, "label").select(*STATISTICS, "label").toPandas())
    return fit_rules(rows[STATISTICS].to_numpy(np.float64), rows["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: RuleModel, folds: int = 5,
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document. A null text is scored as the empty one, repeated
    rows each get a row, a null id counts as '' for the fold; columns other
    than doc_id and text are not read; an empty table gives no rows."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      text_of(F.col("text")).alias("text"))
    return with_statistics(own).select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == 0).alias("held_out"),
        model.column().alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_quality_rules_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
