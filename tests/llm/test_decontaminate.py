import random
import re

from shortbook.llm import decontaminate as D
from shortbook.llm.queries import QUERIES


def grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(docs, items):
    out = set()
    held = {(i, t): grams(t) for i, t in docs}
    wanted = {(i, t): grams(t) for i, t in items}
    for (d, _), g in held.items():
        for (i, _), s in wanted.items():
            if s and 100 * len(s & g) >= 80 * len(s):
                out.add((d, i, len(s), len(s & g)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_common) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    assert want and got(QUERIES["op2_benchmark_decontamination"](spark, sf)) == want


def test_partial_and_scattered_items(spark):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(400)}"
    items = [(k, [word() for _ in range(rnd.choice([3, 5, 9, 14, 40, 200]))]) for k in range(40)]
    docs = []
    for d in range(150):
        own = [word() for _ in range(rnd.randrange(0, 400))]
        for _, w in rnd.sample(items, 2):
            part = list(w)
            for _ in range(rnd.choice([0, 0, 1, 2])):  # edits that may or may not keep 80 %
                part[rnd.randrange(len(part))] = word()
            cut = rnd.randrange(len(part) + 1)
            at, to = sorted((rnd.randrange(len(own) + 1), rnd.randrange(len(own) + 1)))
            own = own[:at] + part[:cut] + own[at:to] + part[cut:] + own[to:]
        docs.append((d, " ".join(own).upper()))
    items = [(k, ", ".join(w)) for k, w in items]
    want = brute(docs, items)
    assert len(want) > 60
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in docs],
                              "doc_id long, text string, item_id int, found_id int, copy int")
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    assert got(D.contamination(d, i)) == want
    hit = {r[0] for r in want}
    kept = D.remove_contaminated(d, i)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, _ in docs if k not in hit]


def test_size_classes_have_their_own_bounds(spark, monkeypatch):
    rnd = random.Random(9)
    text = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    items = [(k, text(rnd.choice([12, 60, 300, 1200]))) for k in range(60)] + [(99, "only four words here")]
    docs = [(k, text(rnd.randrange(80)) + " " + rnd.choice(items)[1] + " " + text(rnd.randrange(80)))
            for k in range(120)] + [(500, "only four words here"), (501, text(900))]
    want = brute(docs, items)
    assert len(want) >= 120
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    for listed in (0, 30, 10**6):
        monkeypatch.setattr(D, "LISTED_VALUES", listed)
        assert got(D.contamination(d, i)) == want
    # the very short item is one listed value, and long items are no bound for short documents
    sketches = D.item_sketches(i).cache()
    bound, listed = D.probe_filter(sketches, 80, 1)
    assert len(listed) == 1
    held = spark.createDataFrame([(5,), (20,), (100,), (2000,)], "held int")
    bounds = [r.bound for r in held.select(bound.alias("bound")).collect()]
    assert bounds == sorted(bounds) and bounds[0] == -(1 << 63) and bounds[1] > bounds[0]
    sketches.unpersist()


def test_edges(spark):
    five = "one two three four five"
    docs = [(1, None), (1, ""), (2, five), (2, five), (None, "x " * 100_000 + five), (4, "a b"), (5, "!!")]
    items = [(1, five), (1, five), (None, five), (2, "A, b!"), (3, ""), (4, None), (5, "a b c")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert got(D.contamination(d, i)) == brute(docs, items)
    assert D.contamination(d.limit(0), i).collect() == []
    assert D.contamination(d, i.limit(0)).collect() == []
    assert len(D.remove_contaminated(d, i.limit(0)).collect()) == len(docs)


def test_no_python_on_the_main_path(spark, sf):
    from conftest import plan_text

    plan = plan_text(QUERIES["op2_benchmark_decontamination"](spark, sf))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
