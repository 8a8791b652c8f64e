"""JSON sources (R9): three landed shapes.

* pages of records, each page a top-level array (filter on one field);
* documents with records nested under ``data.rows`` (missing -> none);
* objects keyed by index (``{"0": {...}, "1": {...}}``), one a file or one a line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_paged_records(
    spark: SparkSession, path: str, record_schema: T.StructType,
    filter_field: str | None = None, filter_value: str | None = None,
) -> DataFrame:
    """Array-per-file pages; every element is a row. Optional equality
    filter (the publish-date filter of weekly pages)."""
    df = spark.read.schema(record_schema).option("multiLine", True).json(path)
    if filter_field is not None:
        df = df.where(F.col(filter_field) == F.lit(filter_value))
    return df


def read_nested_records(
    spark: SparkSession, path: str, record_schema: T.StructType,
    doc_fields: Sequence[tuple[str, T.DataType]] = (), multiline: bool = False,
) -> DataFrame:
    """``{"data": {"rows": [...], <doc_fields>}}`` documents (JSON lines by
    default, splittable) -> one row per record plus the document fields."""
    data = T.StructType(
        [T.StructField("rows", T.ArrayType(record_schema))]
        + [T.StructField(n, t) for n, t in doc_fields]
    )
    doc = T.StructType([T.StructField("data", data)])
    df = spark.read.schema(doc).option("multiLine", multiline).json(path)
    out = df.select(F.explode("data.rows").alias("r"), *[F.col(f"data.{n}").alias(n) for n, _ in doc_fields])
    return out.select(*[F.col(n) for n, _ in doc_fields], "r.*")


def read_keyed_objects(spark: SparkSession, path: str, record_schema: T.StructType | str,
                       key_col: str = "_key", lines: bool = False) -> DataFrame:
    """One JSON object per file, or per line (``lines``, which Spark splits),
    keyed by index -> one row per value."""
    raw = spark.read.option("wholetext", not lines).text(path)
    record = T._parse_datatype_string(record_schema) if isinstance(record_schema, str) else record_schema
    m = F.from_json("value", T.MapType(T.StringType(), record))
    return raw.select(F.explode(m).alias(key_col, "_v")).select(key_col, "_v.*")
