"""Sinks (K1-K7): Parquet / CSV / text writes, named-file layout, retention.

All writes are Spark writes; the only driver-side work is metadata (listing
and renaming finished part files), one call per output file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.names import col as qcol
from shortbook.session import hadoop_fs


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy",
                  partition_by: Sequence[str] = ()) -> str:
    """K1 / K5: one dataset per source; the path may be any Hadoop URI
    (object storage included) -- publishing is the same write."""
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def publish_versioned(df: DataFrame, base: str, stamp: str, partition_by: Sequence[str] = ()) -> str:
    """K1 / K5 without overwriting what readers may be reading: every
    publish is a new ``{base}/v={stamp}`` folder; the newest complete one
    (with ``_SUCCESS``) is the current table (see ``latest_version``)."""
    return write_parquet(df, f"{base.rstrip('/')}/v={stamp}", mode="errorifexists", partition_by=partition_by)


def latest_version(spark: SparkSession, base: str) -> str | None:
    """Newest complete ``v=`` folder under ``base`` (None if there is none)."""
    fs, p = hadoop_fs(spark, base)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return None
    done = [st.getPath() for st in fs.listStatus(p)
            if st.getPath().getName().startswith("v=") and fs.exists(st.getPath().suffix("/_SUCCESS"))]
    return max(done, key=lambda q: q.getName()).toString() if done else None


def write_snapshot_parquet(df: DataFrame, root: str, stamp: str) -> str:
    """K4: gzip Parquet of a deduped table in a new timestamp folder."""
    return write_parquet(df, f"{root.rstrip('/')}/{stamp}", mode="errorifexists", compression="gzip")


# quotes inside a quoted field are doubled, and white space at its ends stays
CSV_OUT = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def append_daily_csv(df: DataFrame, path: str, date_col: str) -> str:
    """K2: append, one folder per day, header in every part file; an empty
    frame creates no day folder."""
    df.write.mode("append").partitionBy(date_col).options(header="true", **CSV_OUT).csv(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """K3: CSV overwrite with header."""
    df.write.mode("overwrite").options(header="true", **CSV_OUT).csv(path)
    return path


def write_named_files(df: DataFrame, root: str, name_col: str, fmt: str = "csv",
                      options: dict | None = None, order: Sequence[str] = ()) -> list[str]:
    """Write ``df`` so that each distinct ``name_col`` value becomes exactly
    one file ``{root}/{name}`` (e.g. ``10-K_filings_2024_Q1.csv``): one
    partitioned write, then one rename per finished part file."""
    spark = df.sparkSession
    staging = root.rstrip("/") + "/_staging"
    out = df.repartition(name_col)
    if order:
        out = out.sortWithinPartitions(name_col, *order)
    w = out.write.mode("overwrite").partitionBy(name_col)
    if fmt == "csv":
        w = w.options(**CSV_OUT)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.format(fmt).save(staging)
    fs, base = hadoop_fs(spark, staging)
    jvm = spark.sparkContext._jvm
    written = []
    it = fs.listFiles(base, True)
    while it.hasNext():
        p = it.next().getPath()
        if not p.getName().startswith("part-"):
            continue
        name = unquote(p.getParent().getName().split("=", 1)[1])  # Spark %-escapes partition values
        dest = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
        fs.rename(p, dest)
        written.append(dest.toString())
    return written


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """K6: (path, length, modificationTime) -- complete listing, content not
    read (the binaryFile content column is pruned when not selected)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", "length", "modificationTime")
    )


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def retention_plan(raw_folders: DataFrame, resampled_folders: DataFrame, col: str = "folder") -> DataFrame:
    """K7 plan: every raw snapshot folder is archived; of the resampled
    folders the newest is kept and the rest archived."""
    raw = raw_folders.select(col).distinct()
    res = resampled_folders.select(col).distinct()
    # one-row maxima joined on a constant key (bounded broadcast, no Cartesian)
    newest_raw = raw.agg(F.max(col).alias("_max")).withColumn("_k", F.lit(1))
    newest_res = res.agg(F.max(col).alias("_max")).withColumn("_k", F.lit(1))
    raw, res = raw.withColumn("_k", F.lit(1)), res.withColumn("_k", F.lit(1))
    a = raw.join(F.broadcast(newest_raw), "_k", "left").select(
        col, F.lit("raw").alias("kind"), (F.col(col) == F.col("_max")).alias("is_latest"),
        F.lit("archive").alias("action"))
    b = res.join(F.broadcast(newest_res), "_k", "left").select(
        col, F.lit("resampled").alias("kind"), (F.col(col) == F.col("_max")).alias("is_latest"),
        F.when(F.col(col) == F.col("_max"), "keep").otherwise("archive").alias("action"))
    return a.unionByName(b)


def folder_checksums(df: DataFrame, folder_col: str) -> DataFrame:
    """(folder, n, sum, xor) per folder: checksums of the rows' content that do
    not depend on their order. Columns go by name."""
    own = F.xxhash64(*[qcol(c) for c in sorted(df.columns) if c != folder_col])
    return df.groupBy(qcol(folder_col).cast("string").alias("folder")).agg(
        F.count("*").alias("n"), F.sum(own.cast("decimal(38,0)")).alias("sum"), F.bit_xor(own).alias("xor"))


def differing_folders(want: DataFrame, archive: DataFrame, folder_col: str) -> DataFrame:
    """Folders of ``want`` (checksums) whose archived content is another, or missing."""
    got = folder_checksums(archive, folder_col)
    return want.join(got.select("folder", F.struct("n", "sum", "xor").alias("got")), "folder", "left").where(
        ~F.struct("n", "sum", "xor").eqNullSafe(F.col("got"))).select("folder")


def archive_snapshots(df: DataFrame, plan: DataFrame, archive_root: str, folder_col: str = "folder") -> int:
    """K7 job: rows of folders planned for 'archive' are rewritten as gzip
    Parquet under ``archive_root``, one partition a folder. A folder that is
    archived again replaces its older copy. The checksums of the source go to a
    manifest (``{archive_root}_manifest``), and the content read back must have
    them, folder by folder, before anything may be removed."""
    spark, root = df.sparkSession, archive_root.rstrip("/")
    todo = plan.where(F.col("action") == "archive").select(folder_col).distinct()
    rows = df.join(todo, folder_col, "left_semi")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
     .partitionBy(folder_col).parquet(root))
    (folder_checksums(rows, folder_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("folder").parquet(f"{root}_manifest"))
    return verify_archive(spark, root, df, folder_col, todo)


def verify_archive(spark: SparkSession, archive_root: str, df: DataFrame, folder_col: str = "folder",
                   folders: DataFrame | None = None) -> int:
    """Rows of the archived folders whose content is that of the manifest; an
    error if a folder's is not. ``df`` gives the columns' types."""
    root = archive_root.rstrip("/")
    kinds = dict(df.dtypes)
    want = spark.read.schema("n long, sum decimal(38,0), xor long, folder string").parquet(f"{root}_manifest")
    if folders is not None:
        want = want.join(folders.select(qcol(folder_col).cast("string").alias("folder")), "folder", "left_semi")
    # the folder is a path segment: read as text, whatever it looks like
    schema = ", ".join(f"`{c}` {'string' if c == folder_col else kinds[c]}" for c in df.columns)
    archive = spark.read.schema(schema).parquet(root)
    if bad := [r["folder"] for r in differing_folders(want, archive, folder_col).limit(5).collect()]:
        raise RuntimeError(f"archive incomplete: folders differ from their source, as {', '.join(bad)}")
    return want.agg(F.sum("n")).first()[0] or 0


def publish_set(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, stamp: str) -> str:
    """K5 for several sources at once: every table goes to a new version folder,
    and one manifest that names all of them is written last. Readers go by
    manifests (``read_set``), so they never see half a run: without the new
    manifest the set before it stays the current one."""
    root = root.rstrip("/")
    rows = [(name, publish_versioned(df, f"{root}/{name}", stamp)) for name, df in tables.items()]
    # one row a source
    found = spark.createDataFrame(rows, "source string, path string")
    return publish_versioned(found.coalesce(1), f"{root}/_sets", stamp)


def read_set(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest complete set, by source."""
    newest = latest_version(spark, f"{root.rstrip('/')}/_sets")
    if newest is None:
        return {}
    return {r["source"]: spark.read.parquet(r["path"]) for r in spark.read.parquet(newest).collect()}


def write_lookup(df: DataFrame, path: str, key: str, order: Sequence[str] = (), folded: str = "_folded") -> str:
    """T2's stored form: the folded key as a column, rows clustered by it, and
    Bloom filters in the files, so that a lookup skips the row groups of others.
    A hot key's rows are spread by ``order``."""
    out = df.withColumn(folded, F.upper(qcol(key)))
    by = [qcol(folded), *[qcol(c) for c in order]]
    (out.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("errorifexists")
     .option(f"parquet.bloom.filter.enabled#{folded}", "true").parquet(path))
    return path


def read_lookup(spark: SparkSession, path: str, value: str, folded: str = "_folded") -> DataFrame:
    """Rows of one key, in any case of its letters: an equality on the stored
    folded key that reaches the row groups' statistics and Bloom filters."""
    # folded here as there, by Spark, and then a plain value for the scan
    target = spark.range(1).select(F.upper(F.lit(value))).first()[0]
    return spark.read.parquet(path).where(qcol(folded) == target).drop(folded)
