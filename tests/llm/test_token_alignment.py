import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shortbook.llm import token_alignment as T
from shortbook.llm.perfect_hash import PerfectHash, bucket_of, build_bucket
from shortbook.llm.queries import QUERIES

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def bytes_of_a(entry):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return bytes(back[c] for c in entry)


def bytes_of_b(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def owners(parts):
    return [k for k, p in enumerate(parts) for _ in p]


def align(text):
    """(ids of A, ids of B, links as index pairs, groups as text), byte by byte."""
    if not text:
        return [], [], [], ""
    raw = (" " + text).encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    pa = [bytes_of_a(A.id_to_token(i)) for i in a]
    pb = [bytes_of_b(B.id_to_piece(i)) for i in b]
    if b"".join(pa) != raw or b"".join(pb) != raw:
        return [], [], [], ""
    own_a, own_b = owners(pa), owners(pb)
    links = sorted(set(zip(own_a, own_b, strict=True)))
    groups, ga, gb = [], [], []
    for k in range(len(raw)):
        end_a = k + 1 == len(raw) or own_a[k + 1] != own_a[k]
        end_b = k + 1 == len(raw) or own_b[k + 1] != own_b[k]
        ga += [str(a[own_a[k]])] * end_a
        gb += [str(b[own_b[k]])] * end_b
        if end_a and end_b:
            groups.append(",".join(ga) + "|" + ",".join(gb))
            ga, gb = [], []
    return a, b, [(a[x], b[y]) for x, y in links], ";".join(groups)


def brute(rows):
    made = [(i, *align(t)) for i, t in rows]
    count = defaultdict(int)
    for *_, links, _ in made:
        for p in set(links):
            count[p] += 1
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted(((i, len(a), len(b), groups.count(";") + bool(groups), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for i, a, b, links, groups in made), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows)
    assert sum(r[5] for r in want) and any(r[5] < r[4] for r in want)
    assert got(QUERIES["op13_token_alignment"](spark, sf)) == want


@pytest.mark.parametrize("at_once,memo", [(1 << 23, 200_000), (2_500, 40)])
def test_edges_shards_and_a_full_memo(spark, monkeypatch, at_once, memo):
    for name, v in (("PAIRS_AT_ONCE", at_once), ("MEMO_CHUNKS", memo), ("STRETCH", 16), ("BUCKET_PAIRS", 50),
                    ("TOKENS_AT_ONCE", 300), ("SENT", 100)):
        monkeypatch.setattr(T, name, v)
    rnd = random.Random(5)
    words = ["the", "naïve", "été", "don't", "x=1;", "漢字", "á", "\U0001f600\U0001f601", "<|endoftext|>", "<s>",
             "2024-01", "...", "ﬁ", "▁", "a\tb", "\r\n", "\xa0", "  ", "\n\n", "\n x", "zzqxj", "Ḝ", "\x00"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 12)))) for k in range(60)]
    rows += [(k, rnd.choice([" ", "\n", ""]).join(rnd.choice(words[:13]) for _ in range(9))) for k in range(100, 130)]
    rows += [(200, None), (201, ""), (202, " "), (203, "\n"), (204, "a " * 20_000 + "é" * 3_000), (None, "the naïve"),
             (205, "the"), (205, "the"), (205, "the été"), (206, " the"), (207, "the ")]
    df = spark.createDataFrame([(*r, "clash", 2, 3) for r in rows],
                               "doc_id long, text string, pair string, rows int, copy int")
    assert got(T.aligned(df.repartition(3))) == brute(rows)
    assert T.aligned(df.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t ab'sA9.,!é漢²ñ▁ﬁ́\U0001f600|<>", max_size=40))
def test_chunks_align_as_whole_texts(text):
    words = T._vocabularies(A_PATH, B_PATH)
    found = words.encode(text) or (b"", b"")
    a, b, links, groups = align(text)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [a, b]
    (made,) = words.align([b"", found[0], b""], [b"", found[1], b""], "<u4")
    assert [(v >> 32, v & (2**32 - 1)) for v in made.links.tolist()] == links
    assert made.texts(words.names()) == ["", groups + ";" if groups else "", ""]
    assert made.link_ends.tolist() == [0, len(links), len(links)]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.integers(1, 5))
def test_perfect_hash(keys, buckets):
    keys = np.array(sorted(keys), np.uint64)
    own = bucket_of(keys, buckets)
    parts = [(b, level, *part) for b in range(buckets) for level, part in enumerate(build_bucket(keys[own == b]))]
    h = PerfectHash(parts, buckets)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    assert (h.keys[h.slots(keys)] == keys).all()
    others = np.array([k for k in range(50) if k not in set(keys.tolist())], np.uint64)
    assert (h.slots(others) == -1).all()


def test_a_block_aligns_each_distinct_chunk_once(monkeypatch):
    words, tokens = T.Vocabularies(A_PATH, B_PATH), []
    align_texts = T.Vocabularies.align
    monkeypatch.setattr(T.Vocabularies, "align", lambda self, a, b, kind: tokens.append(
        sum(map(len, a)) // np.dtype(kind).itemsize) or align_texts(self, a, b, kind))
    rows = [(k, "the cat " * 50 + "naïve, x=1;\n" * k) for k in range(30)] + [(None, None), (40, ""), (41, "the ﬁ cat")]
    ids, numbers, hashes, links, pairs, seen = T.block(words, *map(list, zip(*rows, strict=True)))
    want = [align(t) for _, t in rows]
    assert tokens == [tokens[0]] and tokens[0] < 40 < 5_000 < sum(len(a) for a, *_ in want)
    assert ids == [k for k, _ in rows]
    assert np.frombuffer(numbers, "<u4").reshape(4, -1).T.tolist() == [
        [len(a), len(b), g.count(";") + bool(g), len(found)] for a, b, found, g in want]
    pairs = [(v >> 32, v & (2**32 - 1)) for v in np.frombuffer(pairs, "<u8").tolist()]
    assert [pairs[k] for k in np.frombuffer(links, T.link_kind(len(pairs))).tolist()] == [x for *_, f, _ in want for x in f]
    assert np.frombuffer(seen, "<u4").tolist() == [sum(p in f for *_, f, _ in want) for p in pairs]
    assert hashes == b"".join(hashlib.sha256(g.encode()).digest() for *_, g in want)
