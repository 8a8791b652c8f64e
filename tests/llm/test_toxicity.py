import zlib

import numpy as np
import pytest

from shortbook.llm import toxicity as T
from shortbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    corpus = T.Corpus(["some words here and there", "other words, and there " * 9, ""])
    p = {k: v.astype(np.float64) for k, v in T.new_parameters(rng, len(corpus.vocabulary)).items()}
    ids, owner = corpus.windows()
    y = np.array([0.0, 1.0, 0.0])[owner]
    words, pieces, own = corpus.batch(ids)
    _, g = T.gradients(p, words, pieces, own, y)
    for name, grad in g.items():
        if isinstance(grad, tuple):
            at, rows = grad
            grad = np.zeros_like(p[name])
            grad[at] = rows
        i = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        q = {k: v.copy() for k, v in p.items()}
        q[name][i] += 1e-3
        up = T.gradients(q, words, pieces, own, y)[0]
        q[name][i] -= 2e-3
        down = T.gradients(q, words, pieces, own, y)[0]
        assert (up - down) / 2e-3 == pytest.approx(grad[i], rel=1e-2, abs=1e-6), name


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 100, 101):
        seen = {i for s in T.window_starts(n) for i in range(s, min(s + T.WINDOW, n))}
        assert seen == set(range(n))


def test_finds_toxic_words_anywhere_in_a_text():
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]

    def text(n, bad):
        words = list(rng.choice(plain, n))
        for _ in range(bad):
            words[rng.integers(n)] = rng.choice(["Zyxx!", "wuvq", "ZYXXING"])
        return " ".join(words)

    train = [text(int(rng.integers(5, 80)), 2 * (i % 3 == 0)) for i in range(500)]
    model = T.fit(train, np.array([i % 3 == 0 for i in range(500)], float))
    clean = [text(200, 0) for _ in range(40)]
    bad = [text(200, 0) + " zyxx wuvq " + text(200, 0) for _ in range(40)]
    assert (T.score_texts(model, clean) < 0.5).mean() >= 0.95
    assert (T.score_texts(model, bad) >= 0.5).mean() >= 0.95


def test_held_out_accuracy(spark):
    got = QUERIES["op8_toxicity"](spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    # few labelled rows at this size: 50 toxic ones to learn from
    assert (held.predicted == held.toxic).mean() >= 0.85


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (1, "", 2.0), (None, "Some words.", None), (2, "word " * 300_000, 3.0)],
        "doc_id long, text string, score double")
    labels = spark.createDataFrame([(None, 1)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    rows = T.score(docs, model).collect()
    assert len(rows) == 4 and rows[0].score == rows[1].score == 0
    assert T.score(docs.limit(0), model).collect() == []
    assert T.train(docs.limit(0), labels.limit(0))[1] == {}
