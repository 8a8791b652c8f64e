"""Property tests (hypothesis): the time split is always the sorted prefix,
and keep-last dedupe is idempotent, on generated inputs with ties and nulls."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from shortbook.operators import changes, ranking

T0 = dt.datetime(2024, 1, 1)

times = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=40)


@settings(max_examples=12, deadline=None)
@given(times, st.sampled_from([0.0, 0.29, 0.5, 0.8, 1.0]))
def test_time_split_is_sorted_prefix(spark, ts, frac):
    recs = [(None if t is None else T0 + dt.timedelta(days=t), i) for i, t in enumerate(ts)]
    df = spark.createDataFrame(recs, "TIMESTAMP timestamp_ntz, SEQ long")
    train, test = ranking.time_split(df, "TIMESTAMP", frac, ["SEQ"])
    tr = sorted(r[0] for r in train.select("SEQ").collect())
    te = sorted(r[0] for r in test.select("SEQ").collect())
    order = sorted(recs, key=lambda r: (r[0] is None, r[0] or T0, r[1]))
    k = int(len(recs) * frac)
    assert tr == sorted(s for _, s in order[:k])
    assert te == sorted(s for _, s in order[k:])


rows_st = st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from([None, 0.0, -0.0, 1.5]),
                             st.integers(0, 3)), max_size=30)


@settings(max_examples=12, deadline=None)
@given(rows_st)
def test_keep_last_dedupe_is_idempotent_and_keeps_last(spark, rows):
    recs = [(s, x, T0 + dt.timedelta(days=d), i) for i, (s, x, d) in enumerate(rows)]
    df = spark.createDataFrame(recs, "SYM string, x double, TIMESTAMP timestamp_ntz, SEQ long")
    out = changes.dedupe_keep_last(df, "SEQ")
    got = {(r["SYM"], r["x"]): r["TIMESTAMP"] for r in out.collect()}
    exp = {}
    for s, x, t, _ in recs:  # pandas keep="last" in row order; -0.0 == 0.0
        exp[(s, 0.0 if x == 0 else x)] = t
    assert {(k[0], 0.0 if k[1] == 0 else k[1]): v for k, v in got.items()} == exp
    from pyspark.sql import functions as F
    again = changes.dedupe_keep_last(out.withColumn("SEQ", F.lit(0)), "SEQ")
    assert again.count() == out.count()
