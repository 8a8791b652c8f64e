import zlib

import numpy as np

from shortbook.llm import quality_model as M
from shortbook.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_quality_rules_ensemble"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(got.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (held.predicted == held.quality).mean() >= 0.93


def test_compiled_rules_equal_the_fitted_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = M.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert model.rules
    rows = M.with_statistics(docs.select("doc_id", "text")).withColumn("p", model.column()).toPandas()
    want = model.probabilities(rows[M.STATISTICS].to_numpy(float))
    assert np.allclose(rows.p, want, atol=1e-12)


def test_scoring_runs_no_python(spark, sf):
    from conftest import plan_text

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = M.RuleModel(0.0, (M.Rule((M.Condition("upper", True, 0.5),), 1.0),))
    plan = plan_text(M.score(docs, model))
    assert "Python" not in plan and "Exchange" not in plan


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (1, "", 2.0), (None, "Some words here.", None), (2, "x" * 1_000_000, 3.0)],
        "doc_id long, text string, upper double")
    labels = spark.createDataFrame([(2, 1, None), (7, None, 1), (None, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = M.train(docs, labels)  # one usable label: a constant model
    rows = M.score(docs, model).collect()
    assert len(rows) == 4 and all(0 < r.score < 1 for r in rows)
    assert rows[0].score == rows[1].score
    assert M.score(docs.limit(0), model).collect() == []
    assert M.train(docs.limit(0), labels.limit(0)).rules == ()


def test_statistics_by_hand(spark):
    df = spark.createDataFrame([(1, "AB c!!\nAB |1")], "doc_id long, text string")
    r = M.with_statistics(df).collect()[0]
    assert (r.n_chars, r.n_words, r.n_lines) == (12.0, 4.0, 2.0)
    assert r.distinct_words == 3 / 4 and r.upper == 4 / 12 and r.exclamations == 2 / 12
    assert r.pipes == 1 / 12 and r.digits == 1 / 12 and r.word_length == 9 / 4
