import random
import re
import zlib
from collections import Counter

import pytest
from conftest import plan_text

from shortbook.llm import spelling as S
from shortbook.llm.queries import QUERIES


def brute_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 97 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            found[low] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def variants_of(words):
    """Words near by the strings that lack one letter, verified."""
    lacking = {}
    for w in words:
        for s in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            lacking.setdefault(s, set()).add(w)
    close = {w: set() for w in words}
    for group in lacking.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    return close


def brute(rows):
    words = brute_words(rows)
    close, form = variants_of(words), {}
    for w, some in close.items():
        if some:
            b = min(some, key=lambda x: (-words[x], x))
            if words[b] >= 2 * words[w]:
                form[w] = b
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(close[w]), words.get(f)))
    return sorted(out)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_whole_table_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    assert any(r[1] for r in want)
    assert got(QUERIES["op11_spelling_variants"](spark, sf)) == want


@pytest.mark.parametrize("most", [4, 1_024])
def test_chunks_that_many_words_share(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_PAIRS", most)
    rnd = random.Random(most)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randrange(5, 9))) for _ in range(150)}
    words |= {"prefix" + "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 5))) for _ in range(90)}
    words |= {"z" * 40, "z" * 41, "z" * 20 + "y" + "z" * 20, "étés÷", "étés"}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [(r.u, r.v) for r in S.near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))
    want = {frozenset((a, b)) for a, some in variants_of(words).items() for b in some}
    assert {frozenset(p) for p in pairs} == want and len(pairs) == len(want)


@pytest.mark.parametrize("most", [0, 100_000])
def test_only_counted_keys_are_broadcast(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_PAIRS", 4)
    monkeypatch.setattr(S, "MOST_KEYS", most)
    plans, stored = [], S.stored

    def seen(df, name, *a):
        plans.append((name, plan_text(df)))
        return stored(df, name, *a)

    monkeypatch.setattr(S, "stored", seen)
    rnd = random.Random(7)
    rows = [(k, " ".join("".join(rnd.choice("ab") for _ in range(rnd.randrange(5, 9))) for _ in range(400)))
            for k in range(10)]
    df = S.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    plans.append(("result", plan_text(df)))
    cut = {name for name, plan in plans if "BroadcastExchange" in plan}
    assert cut == ({"cut-chunks", "cut-grams"} if most else set())
    assert "cut-grams" in {name for name, _ in plans}
    want = brute(rows)
    assert any(r[1] for r in want)
    assert got(df) == want


def test_edges(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice(["Received", "recieved", "RECEIVED", "receivd", "réceived", "ÉTUDE",
                                     "étude", "receıved", "x" * 300, "x" * 301, "y" * 70_000])
                         for _ in range(40))) for k in range(30)]
    rows += [(None, rows[0][1]), (3, None), (4, ""), (5, rows[5][1]), (5, rows[5][1]), (-7, "Received, received")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    want = brute(rows)
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)
    assert got(S.variants(df)) == want
    assert S.variants(df.limit(0)).collect() == []


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(S, "MEMO_WORDS", 50)
    monkeypatch.setattr(S, "RUNS_AT_ONCE", 20)
    rows = [(k, " ".join(f"w{chr(97 + k % 26)}{chr(97 + j)}" * 2 for j in range(20))) for k in range(200)]
    counter, found = S.RunCounter(), Counter()
    parts = [*counter.add(*zip(*rows, strict=True)), counter.flush()]
    assert len(parts) > 3 and all(len(w) < 120 for w, _ in parts)
    for words, counts in parts:
        for w, n in zip(words, counts.tolist(), strict=True):
            found[w.decode("latin-1")] += n
    assert {w: n for w, n in found.items() if len(w) >= 5 and n >= 3} == brute_words(rows)
