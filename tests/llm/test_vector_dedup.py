import math

import numpy as np
import pytest

from shortbook.llm import vector_dedup as V
from shortbook.llm.queries import ORACLE, QUERIES


def brute(rows, threshold=0.95):
    n = len(rows)
    links = [set() for _ in rows]
    for a in range(n):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if not all(v and all(c is not None and math.isfinite(c) for c in v) and any(v) for v in (x, y)):
                continue
            if len(x) != len(y):
                continue
            x, y = (np.array(v, np.float64) / np.abs(np.array(v, np.float64)).max() for v in (x, y))
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[a][0], len(links[a]), least, rows[a][0] == least))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force_and_sql(spark, sf, duck):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    mine = got(QUERIES["op12_vector_dedup"](spark, sf))
    assert mine == brute(rows)
    assert mine == sorted(duck.execute(ORACLE["op12_vector_dedup"]).fetchall(), key=repr)


def near(rng, x, cosine):
    y = rng.normal(size=len(x))
    x = x / np.linalg.norm(x)
    y -= (y @ x) * x
    return cosine * x + math.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


@pytest.mark.parametrize("tile,numbers", [(7, 1 << 10), (64, 1 << 22)])
def test_groups_chains_and_edges(spark, monkeypatch, tile, numbers):
    monkeypatch.setattr(V, "TILE_ROWS", tile)
    monkeypatch.setattr(V, "BLOCK_NUMBERS", numbers)
    rng = np.random.default_rng(tile)
    vecs = [rng.normal(size=32) * 10.0 ** rng.integers(-3, 3) for _ in range(60)]
    for k in range(40):  # near the threshold on both sides, and chains
        vecs.append(near(rng, vecs[k if k < 20 else len(vecs) - 1], [0.9499, 0.9501, 0.951, 0.97][k % 4]) * 3)
    vecs += [near(rng, vecs[0], 0.999) for _ in range(30)]
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(len(vecs)), vecs, strict=True)]
    rows += [(500, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (None, [1e-300] * 32), (None, [0.0, 1.0]),
             (501, [2.0 * c for c in rows[5][1]]), (502, [1e300] * 32), (503, [0.0] * 32), (504, None), (505, []),
             (506, [math.nan] * 32), (507, [math.inf, *[1.0] * 31]), (508, [None, *[1.0] * 31]), (509, [1.0] * 3),
             (510, [1.0, 1.0, 1.0]), (511, [-0.0, 1.0, 0.0]), (512, [0.0, 1.0, -0.0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, node string, n_links int")
    want = brute(rows)
    assert got(V.similar_vectors(df.repartition(5))) == want
    assert V.similar_vectors(df.limit(0)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for d in (2, 64, 300):
        x = V.unit(np.concatenate([rng.normal(size=(200, d)), np.eye(d)[:50], rng.normal(size=(50, d)) ** 9]))
        q, scale, lost = V.quantise(x)
        rounded = scale[:, None].astype(float) * q
        off = np.abs(x @ x.T - rounded @ rounded.T)
        assert (off <= lost[:, None] + (1 + lost[:, None]) * lost[None, :]).all()
        b = V.Block(np.arange(len(x)), np.ones(len(x), int), x, q, scale, lost)
        whole = slice(0, len(x))
        found = set(zip(*V.candidates(b, whole, b, whole, 0.9), strict=True))
        assert set(zip(*np.nonzero(x @ x.T >= 0.9), strict=True)) <= found
