"""shortbook: market-data analytics on Spark DataFrames.

Stock-loan change tracking, canned analytics, per-ticker features, splits,
data quality and a run ledger, all expressed with the DataFrame / SQL API.
"""

from shortbook.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
