import hashlib
import math
from collections import defaultdict

from shortbook.llm import mixing as M


def brute(rows, quota, period, block):
    """rows: (doc_id, source, n_chars) -> (doc_id, block, slot, place), by
    simulating earliest deadline first slot by slot until all is placed."""
    by = defaultdict(list)
    for i, s, n in rows:
        v = max(1 if n is None else n, 1)
        by[s].append((hashlib.md5(str(i).encode() if i is not None else b"").hexdigest(),
                      -1 if i is None else i, v, i))
    slot_of, horizon = {}, 0
    for s, own in by.items():
        own.sort()
        total = sum(x[2] for x in own)
        horizon = max(horizon, math.ceil(total / block / quota[s]) * period + period)
    nxt = dict.fromkeys(quota, 0)
    order = sorted(quota, key=lambda s: "" if s is None else "=" + s)
    for t in range(horizon):
        ready = [((nxt[s] + 1) * period + quota[s] - 1) // quota[s] for s in order]
        best = min((d, k) for k, (s, d) in enumerate(zip(order, ready, strict=True))
                   if nxt[s] * period // quota[s] <= t)
        s = order[best[1]]
        assert t < best[0]  # no deadline is missed
        slot_of[s, nxt[s]] = t
        nxt[s] += 1
        for s in order:  # less than one block from the target share
            assert abs(nxt[s] - quota[s] * (t + 1) / period) < 1
    out = []
    for s, own in by.items():
        start = 0
        for _, _, v, i in own:
            out.append((i, start // block, slot_of[s, start // block], start))
            start += v
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.mix.block, r.mix.slot, r.mix.place) for r in df.collect()), key=repr)


def test_whole_table_matches_simulation(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.source, r.n_chars) for r in docs.collect()]
    mixed = M.mix(docs, period=60, block=2_000).cache()
    quota = {r.source: r.quota for r in mixed.select("source", "mix.quota").distinct().collect()}
    assert sum(quota.values()) == 60
    assert got(mixed) == brute(rows, quota, 60, 2_000)


def test_given_weights_nulls_and_repeats(spark):
    rows = [(i, "a" if i % 3 else "b", i % 50 * 7) for i in range(300)]
    rows += [(None, None, None), (5, None, -3), (5, "a", 35), (5, "a", 35), (9, "c", 100_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, source string, n_chars long, mix string, slot int")
    weights = spark.createDataFrame([("a", 0.7), ("b", 0.2), (None, 0.1), ("unused", 3.0)],
                                    "source string, weight double")
    mixed = M.mix(docs, weights, period=50, block=500)
    assert mixed.columns == ["doc_id", "source", "n_chars", "slot", "mix"]
    quota = {r.source: r.quota for r in mixed.select("source", "mix.quota").distinct().collect()}
    assert sum(quota.values()) == 50 and quota["a"] > 3 * quota["b"] > 3 * quota["c"]
    assert got(mixed) == brute(rows, quota, 50, 500)
    assert M.mix(docs.limit(0), weights).collect() == []


def test_more_sources_than_slots(spark):
    rows = [(k * 3_000 + i, f"s{k}", 40 + k) for k in range(130) for i in range(3 + 60 * (k % 40 == 0))]
    mixed = M.mix(spark.createDataFrame(rows, "doc_id long, source string, n_chars long"), period=100, block=500).cache()
    quota = {r.source: r.quota for r in mixed.select("source", "mix.quota").distinct().collect()}
    assert len(quota) == 130 and sum(quota.values()) == 1_300
    assert quota["s120"] > 3 * quota["s119"]
    assert got(mixed) == brute(rows, quota, 1_300, 500)


def test_no_python_on_the_main_path(spark, sf):
    from conftest import plan_text

    plan = plan_text(M.mix(spark.read.parquet(f"{sf}/documents.parquet")))
    assert "Python" not in plan and "CartesianProduct" not in plan
