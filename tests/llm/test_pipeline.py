import os
import zlib

import numpy as np
import test_decontaminate
import test_jaccard_join
import test_mixing
import test_token_files

import corpus_pipeline
from shortbook.llm import mixing, toxicity
from shortbook.llm.queries import QUERIES


def order_of_mixture(rows, quota):
    """doc_ids by (slot, source, place), by the slot-by-slot simulation."""
    placed = test_mixing.brute([(i, s, n) for i, _, s, n in rows], quota, mixing.PERIOD, mixing.BLOCK_CHARS)
    source = {i: s for i, _, s, _ in rows}
    return [i for i, *_ in sorted(placed, key=lambda r: (r[2], source[r[0]], r[3]))]


def test_run_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(r.doc_id, r.text, r.source, r.n_chars) for r in docs.orderBy("doc_id").collect()]
    scores = toxicity.score_texts(model, [r[1] for r in rows])
    rows = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    assert 0 < (scores >= 0.5).sum()
    kept = {i for i, n, c in test_jaccard_join.brute([r[:2] for r in rows], 5, 80) if n == 0 or i == c}
    assert len(kept) < len(rows)
    rows = [r for r in rows if r[0] in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {d for d, *_ in test_decontaminate.brute([r[:2] for r in rows], items)}
    assert bad
    rows = [r for r in rows if r[0] not in bad]
    frame = spark.createDataFrame([(i, s, n) for i, _, s, n in rows], "doc_id long, source string, n_chars long")
    quota = {r.source: r.quota for r in mixing.mix(frame).select("source", "mix.quota").distinct().collect()}
    order = order_of_mixture(rows, quota)
    text = {r[0]: r[1] for r in rows}
    want, start = [], 0
    for i, ids in zip(order, test_token_files.plain([text[i] for i in order]), strict=True):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert test_token_files.got(corpus_pipeline.run(spark, sf)) == want


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing_sources", "token_files"]
    assert len(QUERIES) == 13


def test_edges(spark, sf, tmp_path):
    """Nulls, repeated rows, an extra column, and an empty table, stage by stage."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    own = tmp_path / "data"
    os.mkdir(own)
    labels.write.parquet(f"{own}/labels.parquet")
    rows = [(None, None, None, None, None), (1, "", "en", None, -1), (1, "", "en", None, -1),
            (2, "a lone text", "en", "s", 11), (3, "a lone text", "en", "t", 11), (None, "a lone text", None, "t", 5)]
    docs = spark.createDataFrame(
        [(*r, "extra", 1, 2, 3, 4.0) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, mix string, gone_id int, found_id int, "
        "copy int, component_id double")
    docs.write.parquet(f"{own}/documents.parquet")
    spark.createDataFrame([(1, "nothing of the kind here")], "item_id long, text string") \
        .write.parquet(f"{own}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(own))
        assert out.columns == docs.columns
        assert {r[5:] for r in out.collect()} == {("extra", 1, 2, 3, 4.0)}, name
        assert len(out.collect()) == (5 if name == "ngram_jaccard_join" else 6), name
        assert stage(spark, docs.limit(0), str(own)).collect() == []
    last = corpus_pipeline.write_tokens(spark, docs, str(own)).collect()
    assert sorted(r.n_tokens for r in last)[:3] == [1, 1, 1] and len(last) == 6
