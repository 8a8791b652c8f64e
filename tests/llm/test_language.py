import itertools
import zlib

import numpy as np
import pytest

from shortbook.llm import language as L
from shortbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def small_model(rng, k=3):
    return L.LanguageModel([f"l{i}" for i in range(k)], rng.normal(size=(L.BUCKETS, k)), {},
                           rng.normal(size=(k + 1, k)), rng.normal(size=(k, k)), rng.normal(size=k))


def brute_posteriors(model, scores):
    """By enumerating every label sequence."""
    n, k = scores.shape
    post = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = model.start[path[0]] + sum(scores[i, y] for i, y in enumerate(path))
        w += sum(model.transitions[a, b] for a, b in itertools.pairwise(path))
        for i, y in enumerate(path):
            post[i, y] += np.exp(w)
    return post / post.sum(axis=1, keepdims=True)


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(L, "SEGMENT", 4)
    rng = np.random.default_rng(1)
    model = small_model(rng)
    sizes = [1, 6, 3, 7, 1, 2]
    parts = [rng.normal(size=(n, 3)) * 2 for n in sizes]
    first = np.concatenate([np.arange(n) == 0 for n in sizes])
    got = L.posteriors(model, np.concatenate(parts), first)
    assert np.allclose(got, np.concatenate([brute_posteriors(model, p) for p in parts]), atol=1e-9)


def test_memory_with_many_languages():
    import tracemalloc

    rng = np.random.default_rng(8)
    k = 60
    model = L.LanguageModel([f"l{i}" for i in range(k)], rng.normal(size=(L.BUCKETS, k)).astype(np.float32), {},
                            rng.normal(size=(k + 1, k)), rng.normal(size=(k, k)), rng.normal(size=k))
    words = ["".join(map(chr, rng.integers(97, 123, size=5))) for _ in range(5_000)]
    text = " ".join(words[i] for i in rng.integers(5_000, size=167_000))
    assert len(text) > 1_000_000
    tracemalloc.start()
    names, shares, _ = L.label_texts(model, [text, None])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert names[1] == L.UNKNOWN and 0 < shares[0] <= 1
    assert peak < 500e6, peak


def test_spans_of_letters_that_become_two():
    rng = np.random.default_rng(9)
    text = "İstanbul ve İzmir bir"
    _, _, (runs,) = L.label_texts(small_model(rng), [text], spans=True)
    assert runs[0][0] == 0 and runs[-1][1] == len(text)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    model = small_model(rng)
    scores, y = rng.normal(size=(2, 5, 3)), rng.integers(3, size=(2, 5))
    _, gs, gt, g0 = L._batch_gradient(model, scores, y)

    def value():
        return L._batch_gradient(model, scores, y)[0]

    for array, grad in ((scores, gs), (model.transitions, gt), (model.start, g0)):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        array[at] += 1e-5
        up = value()
        array[at] -= 2e-5
        down = value()
        array[at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(grad[at], rel=1e-5)


def test_held_out_accuracy(spark):
    got = QUERIES["op4_language_id"](spark, SF).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{SF}/documents.parquet").toPandas(), on="doc_id")
    assert (held.lang_pred == held.lang).mean() >= 0.98


def test_code_switched_text_is_labelled_by_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.train(docs)
    rows = docs.filter("length(text) between 300 and 3000 and lang in ('en', 'de')").orderBy("doc_id").collect()
    pick = {lang: [r.text for r in rows if r.lang == lang][:10] for lang in ("en", "de")}
    right = total = 0
    for a, b in zip(pick["en"], pick["de"], strict=True):
        a, b = " ".join(a.split()[:25]), " ".join(b.split()[:25])
        text = a + " " + b
        names, _, runs = L.label_texts(model, [text], spans=True)
        for s, e, lang in runs[0]:
            cut = min(max(len(a), s), e)
            right += (cut - s) * (lang == "en") + (e - cut) * (lang == "de")
            total += e - s
    assert right >= 0.93 * total
    assert model.transitions.diagonal().min() > (model.transitions - 99 * np.eye(4)).max()


def test_every_language_is_sampled(spark, monkeypatch):
    """More than a hundred languages; one of mainly and one of only long texts."""
    drawn = []
    monkeypatch.setattr(L, "fit", lambda texts, langs: drawn.extend(zip(langs, texts, strict=True)))
    rows = [(k * 10 + i, f"w{k} x", f"l{k}") for k in range(130) for i in range(6)]
    rows += [(10_000 + i, "long " * 100, "mostly") for i in range(1_200)]
    rows += [(20_000 + i, f"short {i}", "mostly") for i in range(30)]
    rows += [(30_000 + i, "only " * 100, "long") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    L.train(docs, sample_docs=50, sample_chars=100)
    assert {lang for lang, _ in drawn} == {f"l{k}" for k in range(130)} | {"mostly", "long"}
    usable = [i for i in range(20_000, 20_030) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(t for lang, t in drawn if lang == "mostly") == sorted(f"short {i - 20_000}" for i in usable)
    assert {t for lang, t in drawn if lang == "long"} == {("only " * 100)[:100]}


def test_edges(spark):
    rows = [(1, None, "en", 1), (1, "", "en", 2), (None, "12 ½ !?", "de", 3), (2, "the cat " * 100_000, None, 4)]
    rows += [(i, "the cat and the dog" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de", 5)
             for i in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = L.train(docs)
    rows = L.predict(docs, model, spans=True).collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and rows[2].score == 0
    assert rows[3].lang_pred == "en" and rows[3].spans[-1].end == len("the cat " * 100_000) - 1
    assert L.predict(docs.limit(0), model).collect() == []
    none = L.train(docs.limit(0))
    assert {r.lang_pred for r in L.predict(docs, none).collect()} == {"und"}
