"""File listing sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.session import hadoop_fs
from shortbook.sources.sinks import list_files


def newest_file(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path of the most recently modified file (recursive), one row."""
    return list_files(spark, root, glob, recursive=True).agg(
        F.max_by("path", "modificationTime").alias("path"),
        F.max("modificationTime").alias("modificationTime"),
    )


def inventory(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """A2 / A3: per Parquet table under ``root`` -- a ``*.parquet`` file or
    folder, or a versioned publish folder (its newest complete version) --
    rows (from Parquet footers), columns, bytes and MB (÷1e6, 2 dp)."""
    from shortbook.sources.sinks import latest_version
    fs, base = hadoop_fs(spark, root)
    rows = []
    for st in sorted(fs.listStatus(base), key=lambda s: s.getPath().getName()):
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if name.endswith(suffix):
            table, target = name[: -len(suffix)], st.getPath()
        elif st.isDirectory() and latest_version(spark, st.getPath().toString()):
            table = name
            target = fs.makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                latest_version(spark, st.getPath().toString())))
        else:
            continue
        path = target.toString()
        df = spark.read.parquet(path)
        size = int(fs.getContentSummary(target).getLength())
        rows.append((table, path, df.count(), len(df.columns), list(df.columns), size))
    schema = "table string, path string, rows long, n_columns int, columns array<string>, size_bytes long"
    out = spark.createDataFrame(rows, schema)
    return out.withColumn("size_mb", F.round(F.col("size_bytes") / F.lit(1e6), 2))
