import random

import numpy as np
import pytest

from shortbook.llm import jaccard_join as J
from shortbook.llm.components import components
from shortbook.llm.queries import QUERIES


def shingles(text, size=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=3, percent=90):
    """(doc_id, text) -> the query's rows, by all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) \
                    and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op9_ngram_jaccard_join"](spark, sf)) == brute(rows)


@pytest.mark.parametrize(("frequent", "pair_prefix"), [(2, 40), (2, 5), (64, 40)])
def test_groups_of_near_copies(spark, monkeypatch, frequent, pair_prefix):
    """Near copies around the threshold, chains, a shared passage, exact copies."""
    monkeypatch.setattr(J, "FREQUENT", frequent)
    monkeypatch.setattr(J, "FREQUENT_MEANS", 0)
    monkeypatch.setattr(J, "PAIR_PREFIX", pair_prefix)
    rnd = random.Random(frequent * 100 + pair_prefix)
    word = lambda: f"w{rnd.randrange(300)}"
    passage = [word() for _ in range(40)]
    docs = []
    for _ in range(25):
        base = [word() for _ in range(rnd.choice([2, 8, 12, 30, 60, 120, 400]))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.choice([1, 2, 8])):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                own[rnd.randrange(len(own))] = word()
            base = own if rnd.random() < 0.3 else base  # chains drift away
            docs.append(" ".join(own))
    rnd.shuffle(docs)
    rows = [(i, t.upper() if i % 5 == 0 else t) for i, t in enumerate(docs)]
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows],
                               "doc_id long, text string, node int, component string")
    assert got(J.similar_sets(df)) == want


@pytest.mark.parametrize(("size", "percent", "least"), [(3, 90, 9), (5, 80, 4)])
def test_a_set_inside_one_a_shingle_larger(spark, size, percent, least):
    """Texts next to the same text plus one word, at every size around the
    least one that has a link."""
    rows = []
    for n in range(1, 15):
        words = [f"t{n}w{k}" for k in range(n + size)]
        rows += [(2 * n, " ".join(words[:-1])), (2 * n + 1, " ".join(words))]
    want = brute(rows, size, percent)
    assert sorted(i // 2 for i, _, c in want if c != i) == [n for n in range(1, 15) if n >= least]
    assert got(J.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"),
                              size=size, percent=percent)) == sorted(want, key=repr)


def test_edges(spark):
    text = " ".join(f"a{k}" for k in range(50))
    rows = [(1, None), (1, ""), (2, " \t\n"), (5, "One two"), (4, "one\x0btwo"), (4, "one\x0btwo"),
            (None, text), (9, text), (8, text + " end"), (None, None), (3, "x " * 100_000), (7, "lone"),
            (None, "only null"), (6, "É é"), (6, "é É")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(i, n, i if not n else c) for i, n, c in brute(rows)]
    assert got(J.similar_sets(df)) == sorted(want, key=repr)
    assert J.similar_sets(df.limit(0)).collect() == []


def test_parity_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for size in [300] * 25 + [600, 5_000]:
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, 20).astype(np.uint64)]))
        p, q = sorted((J.parity(a), J.parity(b)), key=len)
        assert len(q) in (len(p), 2 * len(p))
        if len(q) > len(p):
            q = q[:len(p)] ^ q[len(p):]
        bits = sum(int(x).bit_count() for x in (p ^ q).view(np.uint64))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 200), (200, 300)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[k] for k in range(100, 140)} == {100}
    assert got[300] == got[200] == 200 and len(got) == 61 + 40 + 2
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
