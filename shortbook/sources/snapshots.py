"""Stock-loan snapshot text files (R6, R7, R8) and their writer.

Layout: ``{root}/{YYYY-MM-DD_HH-MM-SS}/{country}.txt``; each file is
pipe-delimited with ``#BOF|YYYY.MM.DD|HH:MM:SS``, a ``#SYM|...`` header,
data rows and ``#EOF``. Files are read with the splittable ``text`` source
(one row per line, never one row per file). Line order inside a file is
(split start, monotonically increasing id), fixed right at the scan. The
last header and the last BOF of each file apply to all its rows; they are
gathered into a one-row-per-file table and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.functions.text import file_stem, null_placeholders, to_double
from shortbook.operators.changes import strip_ws
from shortbook.schemas import (
    BOF_FORMAT,
    CHANGE_COLS,
    SNAPSHOT_FOLDER_FORMAT,
    SNAPSHOT_PLACEHOLDERS,
    SYMBOL_COL,
)
from shortbook.session import hadoop_fs

# Declared output columns and the header names accepted for each.
COLUMN_ALIASES = {
    "SYM": ["SYM"],
    "CURRENCY": ["CURRENCY", "CUR"],
    "NAME": ["NAME"],
    "CON": ["CON", "IB_CONTRACT_ID"],
    "ISIN": ["ISIN"],
    "REBATERATE": ["REBATERATE", "REBATE_RATE"],
    "FEERATE": ["FEERATE", "FEE_RATE"],
    "AVAILABLE": ["AVAILABLE", "AVAILABLE_SHARES"],
}

_FOLDER_IN_PATH = r"/(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})/[^/]+$"


def read_snapshot_lines(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """R6 + scan: every line of every ``*.txt`` in a timestamp-named folder
    (case-sensitive glob, as the processing step), with its file, folder
    time and in-file order."""
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(root)
        .select(
            F.col("value").alias("raw"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("_blk"),
        )
    )
    return prepare_lines(raw)


def prepare_lines(raw: DataFrame) -> DataFrame:
    """Lines (raw, file_path, file_name, _blk) straight from a file scan ->
    + in-file order, snapshot folder and time; lines outside a
    timestamp-named folder are dropped. Must run before any shuffle: the
    monotonically increasing id is only meaningful in scan order."""
    folder = F.regexp_extract("file_path", _FOLDER_IN_PATH, 1)
    return (
        raw.withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("folder", folder)
        .where(F.col("folder") != "")
        .withColumn("snapshot_ts", F.try_to_timestamp("folder", F.lit(SNAPSHOT_FOLDER_FORMAT)).cast("timestamp_ntz"))
        .withColumn("line", strip_ws(F.col("raw")))
        .withColumn("_pos", F.struct("_blk", "_mid"))
    )


def _kind(line: Column) -> Column:
    up = F.upper(line)
    return (
        F.when(line == "", "blank")
        .when(line.startswith("#BOF"), "bof")
        .when(line.startswith("#EOF"), "eof")
        .when(up.startswith("#SYM|") | up.startswith("#SYM\t"), "header")
        .when(line.startswith("#"), "comment")
        .otherwise("data")
    )


def parse_bof(line: Column) -> Column:
    """``#BOF|YYYY.MM.DD|HH:MM:SS`` -> timestamp, null when unparsable."""
    parts = F.split(line, r"\|")
    text = F.concat(strip_ws(F.get(parts, 1)), F.lit(" "), strip_ws(F.get(parts, 2)))
    return F.when(F.size(parts) >= 3, F.try_to_timestamp(text, F.lit(BOF_FORMAT))).cast("timestamp_ntz")


def parse_snapshot_text(
    spark: SparkSession,
    root: str,
    glob: str = "*.txt",
    columns: Sequence[str] = tuple(COLUMN_ALIASES),
) -> DataFrame:
    """Parsed rows of every snapshot file under ``root``.

    Output: declared columns (string; AVAILABLE/FEERATE/REBATERATE double),
    EXTRA (other header columns as sorted name/value pairs), COUNTRY (file
    stem, upper), snapshot_ts (folder time), bof_ts (BOF time,
    else folder time), file_path, and ``_order`` (snapshot, file, line) for
    keep-last rules. Files without a header or without data rows yield none.
    """
    from shortbook.sources.sinks import list_files
    # the per-file table has one row per file: the file listing (metadata
    # only, no content read) proves its size before it is broadcast
    n_files = list_files(spark, root, glob).count()
    return parse_lines(read_snapshot_lines(spark, root, glob), columns, n_files=n_files)


def parse_lines(lines: DataFrame, columns: Sequence[str] = tuple(COLUMN_ALIASES),
                n_files: int | None = None) -> DataFrame:
    """R7 on prepared lines (see ``prepare_lines``). ``n_files`` (from a
    listing) bounds the per-file table; without it the table is counted."""
    lines = lines.withColumn("_kind", _kind(F.col("line")))
    headers = (
        lines.where(F.col("_kind") == "header")
        .groupBy("file_path")
        .agg(F.max_by("line", "_pos").alias("_header"))
    )
    bofs = (
        lines.where(F.col("_kind") == "bof")
        .groupBy("file_path")
        .agg(F.max_by("line", "_pos").alias("_bof"))
    )
    files = headers.join(bofs, "file_path", "left").withColumn("_bof_ts", parse_bof(F.col("_bof")))
    # Header cells: drop '#', split on '|', strip, drop blanks, upper-case.
    cells = F.transform(F.split(F.expr("substring(_header, 2)"), r"\|"), lambda x: F.upper(strip_ws(x)))
    files = files.withColumn("_names", F.filter(cells, lambda x: x != "")).select(
        "file_path", "_names", "_bof_ts"
    )
    data = lines.where(F.col("_kind") == "data").join(files, "file_path")
    vals = F.transform(F.split(F.col("line"), r"\|", -1), strip_ws)
    data = data.withColumn("_vals", vals)

    def cell(name: str) -> Column:
        # first matching header position; short rows pad with '' (-> null)
        pos = None
        for alias in COLUMN_ALIASES.get(name, [name]):
            p = F.array_position(F.col("_names"), alias)
            pos = p if pos is None else F.when(pos > 0, pos).otherwise(p)
        v = F.coalesce(F.get(F.col("_vals"), (pos - 1).cast("int")), F.lit(""))
        return F.when(pos > 0, v)

    # undeclared header columns: (name, value) pairs, first occurrence of a
    # name wins, sorted by name -- an array of structs stays groupable
    declared = sorted({a for c in columns for a in COLUMN_ALIASES.get(c, [c])})
    row = F.transform(F.col("_names"), lambda n, i: F.coalesce(F.get(F.col("_vals"), i), F.lit("")))
    pairs = F.transform(F.arrays_zip(F.col("_names").alias("name"), row.alias("value")),
                        lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value")))
    extra = F.filter(pairs, lambda x, i: ~x["name"].isin(declared)
                     & (F.array_position(F.col("_names"), x["name"]) == i + 1))
    extra = F.array_sort(F.transform(extra, lambda x: F.struct(
        x["name"].alias("name"),
        F.when(~x["value"].isin(SNAPSHOT_PLACEHOLDERS), x["value"]).alias("value"))))
    out = data.select(
        *[cell(c).alias(c) for c in columns],
        extra.alias("EXTRA"),
        file_stem(F.col("file_name")).alias("_stem"),
        "file_path", "snapshot_ts", "_bof_ts", "_pos",
    )
    # Symbols: upper + strip, drop empty -- before placeholders become null,
    # so the literal ticker "NA" keeps its row with a null symbol.
    if SYMBOL_COL in columns:
        out = out.withColumn(SYMBOL_COL, strip_ws(F.upper(F.col(SYMBOL_COL))))
        out = out.where(F.col(SYMBOL_COL).isNull() | (F.length(SYMBOL_COL) > 0))
    for c in columns:  # V4: placeholders -> null, change columns -> double
        v = null_placeholders(c, SNAPSHOT_PLACEHOLDERS)
        out = out.withColumn(c, to_double(v) if c in CHANGE_COLS else v)
    return out.select(
        *columns,
        "EXTRA",
        F.upper("_stem").alias("COUNTRY"),
        "snapshot_ts",
        F.coalesce("_bof_ts", "snapshot_ts").alias("bof_ts"),
        "file_path",
        F.struct("snapshot_ts", "file_path", "_pos").alias("_order"),
    )


# ------------------------------------------------------------------ writer

def write_snapshot_text(
    df: DataFrame,
    root: str,
    folder_col: str,
    country_col: str,
    order_col: str,
    columns: Sequence[str],
    bof_col: str | None = None,
) -> str:
    """Write rows as snapshot text files ``{root}/{folder}/{country}.txt``.

    Lines are built and ordered by Spark, written with one partitioned text
    write, then each part file is moved to its final name (metadata-only
    rename on the driver, one per file). ``bof_col`` (timestamp) adds a BOF
    line when not null.
    """
    spark = df.sparkSession
    staging = root.rstrip("/") + "/_staging"

    def fmt(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("NA"))

    data = df.select(
        F.col(folder_col).alias("folder"),
        F.lower(F.col(country_col)).alias("country"),
        F.lit(2).alias("_k"),
        F.col(order_col).cast("long").alias("_o"),
        F.concat_ws("|", *[fmt(c) for c in columns]).alias("value"),
    )
    per_file = df.groupBy(F.col(folder_col).alias("folder"), F.lower(F.col(country_col)).alias("country"))
    meta = per_file.agg(
        (F.max(bof_col) if bof_col else F.lit(None).cast("timestamp")).alias("_bof")
    )
    bof = meta.where(F.col("_bof").isNotNull()).select(
        "folder", "country", F.lit(0).alias("_k"), F.lit(0).cast("long").alias("_o"),
        F.concat(F.lit("#BOF|"), F.date_format("_bof", "yyyy.MM.dd|HH:mm:ss")).alias("value"),
    )
    head = meta.select(
        "folder", "country", F.lit(1).alias("_k"), F.lit(0).cast("long").alias("_o"),
        F.lit("#" + "|".join(columns)).alias("value"),
    )
    eof = meta.select(
        "folder", "country", F.lit(3).alias("_k"), F.lit(0).cast("long").alias("_o"), F.lit("#EOF").alias("value")
    )
    lines = data.unionByName(bof).unionByName(head).unionByName(eof)
    (
        lines.repartition("folder", "country")
        .sortWithinPartitions("folder", "country", "_k", "_o")
        .select("folder", "country", "value")
        .write.mode("overwrite")
        .partitionBy("folder", "country")
        .text(staging)
    )
    fs, base = hadoop_fs(spark, staging)
    jvm = spark.sparkContext._jvm
    it = fs.listFiles(base, True)
    while it.hasNext():
        st = it.next()
        p = st.getPath()
        name = p.getName()
        if not name.startswith("part-"):
            continue
        country = unquote(p.getParent().getName().split("=", 1)[1])  # Spark %-escapes values
        folder = unquote(p.getParent().getParent().getName().split("=", 1)[1])
        dest_dir = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{folder}")
        fs.mkdirs(dest_dir)
        fs.rename(p, jvm.org.apache.hadoop.fs.Path(dest_dir, f"{country}.txt"))
    return root
