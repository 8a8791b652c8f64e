import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shortbook.llm import suffix_dedup as S
from shortbook.llm.queries import QUERIES


def brute(rows):
    """(doc_id, text) -> the query's rows."""
    least = {}
    data = [((2**63 - 1 if i is None else i), i, (t or "").encode()) for i, t in rows]
    for d, _, raw in data:
        for k in range(len(raw) - 49):
            s = raw[k:k + 50]
            least[s] = min(least.get(s, d), d)
    out = []
    for d, i, raw in data:
        gone = bytearray(len(raw) + 1)
        for k in range(len(raw) - 49):
            if least[raw[k:k + 50]] < d:
                gone[k:k + 50] = b"\x01" * 50
        spans = sum(gone[k] and not gone[k + 1] for k in range(len(raw)))
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=repr)


def test_whole_table_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op7_suffix_dedup"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("hot", [2, 2_000])
def test_copies_passages_and_periodic_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rnd = random.Random(hot)
    make = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    shared = [make(rnd.choice([49, 50, 51, 80, 300])) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            parts += [make(rnd.randrange(0, 60)), rnd.choice(shared)]
        if i % 10 == 0:
            parts.append("ab" * rnd.randrange(10, 90))
        if i % 12 == 0:
            parts.append("x" * rnd.randrange(40, 200))
        rows.append((i * 7 % 60, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (None, rows[4][1]), (7, rows[5][1]), (7, rows[5][1]),
             (7, make(90)), (8, None), (9, ""), (9, "x" * 49), (200, rows[6][1] * 20)]
    df = spark.createDataFrame([(*r, b"clash", 3) for r in rows], "doc_id long, text string, raw binary, doc int")
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert got(S.remove_repeats(df)) == want
    kept = {r.kept_sha256: hashlib.sha256(r.kept).hexdigest() for r in S.remove_repeats(df, keep_bytes=True).collect()}
    assert all(a == b for a, b in kept.items())
    assert S.remove_repeats(df.limit(0)).collect() == []


def test_a_very_long_text(spark):
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(300_000))
    rows = [(2, long), (1, long[100_000:100_200]), (3, "z" * 100_000), (4, "z" * 60)]
    assert got(S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_equal_strings_pick_equal_anchors():
    rnd = random.Random(2)
    for _ in range(50):
        core = bytes(rnd.choice(b"ab") for _ in range(120))
        texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(60))) + core for _ in range(2)]
        picks = []
        for t in texts:
            value, _, first, end = S.anchors(t)
            assert first[0] == 0 and end[-1] == len(t) - 49 and (first[1:] == end[:-1]).all()
            of = np.repeat(value, end - first)
            picks.append(of[len(t) - 120:])
        assert (picks[0] == picks[1]).all()


def test_suffixes_are_sorted():
    rnd = random.Random(3)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(50, 90))) for _ in range(60)]
    data = np.frombuffer(b"".join(parts) + bytes(50), np.uint8)
    starts = np.cumsum([0, *map(len, parts)])
    at = np.concatenate([np.arange(starts[k], starts[k + 1] - 49) for k in range(60)])
    group = np.concatenate([np.full(starts[k + 1] - 49 - starts[k], k // 7) for k in range(60)])
    order = S.sort_suffixes(data, at, group)
    raw = data.tobytes()
    keys = [(group[o], raw[at[o]:at[o] + 50]) for o in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(at)))


def test_groups_in_pieces_are_resolved_as_in_one():
    """Sorted rows arrive in pieces; a group may take many of them."""
    rnd = random.Random(4)
    shared = ["".join(rnd.choice("abc ") for _ in range(n)) for n in (60, 90, 200)]
    texts = ["".join(rnd.choice([rnd.choice(shared), "z" * rnd.randrange(40, 90)]) for _ in range(3)).encode()
             for _ in range(40)]
    common = np.unique(np.concatenate([S.anchors(t)[0] for t in texts]))
    some, many = common[::2], common[1::2]
    rows = [(key, doc // 2, doc % 2, start, context) for doc, t in enumerate(texts)
            for out in S.shared_contexts(t, some, many)
            for key, start, context in zip(out[0].tolist(), out[1].tolist(), out[2].to_pylist(), strict=True)]
    rows.sort(key=lambda r: r[:2])
    names = ["key", "doc", "copy", "start", "context"]
    table = pa.table({n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)})

    def covered(found):
        bytes_gone = set()
        for doc, copy, begin, end in zip(*(f.tolist() for f in found), strict=True):
            bytes_gone |= {(doc, copy, k) for k in range(begin, end)}
        return bytes_gone

    want = covered(S.resolve(table, True)[0])
    least = {}
    for doc, t in enumerate(texts):
        for k in range(len(t) - 49):
            least.setdefault(t[k:k + 50], doc // 2)
    assert want == {(doc // 2, doc % 2, j) for doc, t in enumerate(texts) for k in range(len(t) - 49)
                    if least[t[k:k + 50]] < doc // 2 for j in range(k, k + 50)}
    for step in (1, 7, 200):
        held, got_ = table.slice(0, 0), set()
        for k in range(0, len(table), step):
            found, held = S.resolve(pa.concat_tables([held, table.slice(k, step)]), False)
            got_ |= covered(found)
        assert got_ | covered(S.resolve(held, True)[0]) == want
