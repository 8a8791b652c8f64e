import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shortbook.llm import token_files as D
from shortbook.llm.queries import QUERIES
from shortbook.session import scratch_dir


def plain(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [0] for e in t.encode_batch(texts, add_special_tokens=False)]


def brute(rows):
    """(doc_id, text) in file order -> the query's rows."""
    out, start = [], 0
    for (i, _), ids in zip(rows, plain([t or "" for _, t in rows]), strict=True):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()),
                  key=lambda r: r[1])


def test_whole_table_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    assert got(QUERIES["op5_token_files"](spark, sf)) == brute([(d.doc_id, d.text) for d in docs])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_codes_round_trip_and_direct_access(ids):
    codes = D.Codes(D.encode_codes(np.array(ids, np.uint32)))
    assert codes.all().tolist() == ids
    assert [codes[i] for i in range(len(codes))] == ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t\r \x1c ab'sA9.,!é漢²ñſ\U0001f600|<>", max_size=60))
def test_chunks_give_the_ids_of_the_whole_text(text):
    raw = D.Encoder(public_tokenizers.path("byte_bpe_50k.json")).encode(text)
    assert np.frombuffer(raw, "<u4").tolist() == plain([text])[0][:-1]


def test_special_tokens_are_the_librarys():
    encoder = D.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "x<|endoftext|>\n\n y", "<|endoftext|", "a <|endof", "text|>"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain([text])[0][:-1]


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(D, "MEMO_CHUNKS", 50)
    e = D.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for k in range(30):
        text = " ".join(f"w{k}x{j}" for j in range(20))
        assert np.frombuffer(e.encode(text), "<u4").tolist() == plain([text])[0][:-1]
        assert len(e.memo) <= 50 and len(e.old) <= 50


def test_edges_and_direct_access_to_files(spark):
    rows = [(None, "null id"), (1, None), (1, None), (2, ""), (3, "x y z" * 50_000), (9, "<|endoftext|> end")]
    docs = spark.createDataFrame([(i, t, 1.5, "clash") for i, t in rows],
                                 "doc_id long, text string, start double, payload string")
    path = scratch_dir(spark, "tokens")
    D.write_tokens(docs.repartition(3), path)
    want = brute(rows)
    assert got(D.read_documents(spark, path)) == want
    flat = [t for ids in plain([t or "" for _, t in rows]) for t in ids]
    places = [0, 3, len(flat) // 2, len(flat) - 1, len(flat), -1]
    found = {r.position: r.token for r in D.tokens_at(spark, path, places).collect()}
    assert found == {p: flat[p] for p in places if 0 <= p < len(flat)}
    empty = scratch_dir(spark, "tokens")
    D.write_tokens(docs.limit(0), empty)
    assert D.read_documents(spark, empty).collect() == []
