"""Write PLANS.md: physical plan trees of the headline queries at sf0.1.

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shortbook.operators import features, joins  # noqa: E402
from shortbook.plans import registry, views  # noqa: E402
from shortbook.session import get_spark  # noqa: E402

KEYS = ["top_short_borrow", "ticker_history", "availability_changes", "dedupe_keep_last", "change_history",
        "pct_rank", "pct_rank_global", "time_split_train", "filings_enriched", "quality_by_file", "asof_join",
        "parse_snapshot_text", "zscore_hot_ticker", "asof_hot_ticker"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().split("\n\n")[0]
    return re.sub(r"#\d+", "", text).strip()


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans", "",
           "Generated by `tools/plans.py` at " + os.path.basename(sf) + " (local[8], 8 shuffle partitions).",
           "Adaptive plans are shown before execution. Checkpointed inputs appear as `Scan ExistingRDD`.", ""]
    for k in KEYS:
        out += [f"## {k}", "", "```", tree(registry.QUERIES[k](spark, sf)), "```", ""]
    sl = views.stock_loan(spark, sf)
    forced = features.add_ticker_features(
        sl, [features.z_score_feature("FEERATE", 20), features.lag_feature("AVAILABLE", 1)],
        tie_breakers=["SEQ"], skew_safe=True)
    out += ["## per-ticker features, skew-safe path (forced)", "", "```", tree(forced), "```", ""]
    e = views.earnings(spark, sf).groupBy("symbol", "reportDate").count()
    e = e.withColumn("rt", e["reportDate"].cast("date").cast("timestamp_ntz"))
    a = joins.asof_join(sl.select("SYM", "SEQ", "TIMESTAMP"), e, ["SYM"], "TIMESTAMP", "rt", ["reportDate"],
                        right_by=["symbol"], skew_safe=True)
    out += ["## as-of join, skew-safe path (forced)", "", "```", tree(a), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
