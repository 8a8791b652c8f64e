"""CSV sources.

A plain multi-file CSV read aligns columns by *position*; files whose
headers differ would be mixed up. So files are grouped by their header
line first, each group is read with its own schema, and the groups are
unioned by column name.

The scan that finds the headers also counts quotes. A line with an odd number
of them opens or closes a field that goes on in another line. Files without
such lines are split and read as they are. In the others a split may begin
inside a field: the odd lines before it, summed over the splits in front, say
whether it does, so these files are read by as many tasks as they have splits,
too, and only lines of records that span several are brought together.
"""

from __future__ import annotations

import csv as pycsv
import io
import logging
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortbook.functions.text import file_prefix
from shortbook.operators.relational import coerce_types, union_by_name
from shortbook.schemas import PANDAS_NA_TOKENS

log = logging.getLogger(__name__)


# quotes inside a quoted field are doubled
DIALECT = {"header": "true", "mode": "PERMISSIVE", "escape": '"'}


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _na_to_null(df: DataFrame, keep_cols=()) -> DataFrame:
    """compat: the CSV null tokens of pandas -> null, except symbol columns
    (a real ticker "NA" must survive)."""
    out = []
    for c in df.columns:
        if c in keep_cols or c.upper() in ("SYM", "SYMBOL"):
            out.append(F.col(f"`{c}`"))
        else:
            out.append(F.when(~F.col(f"`{c}`").isin(PANDAS_NA_TOKENS), F.col(f"`{c}`")).alias(c))
    return df.select(*out)


def read_csv_table(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType] | None = None,
    infer: bool = False,
    na_compat: bool = False,
) -> DataFrame:
    """R2: one CSV with header, or a folder of its parts. Text columns by
    default (no inference, so leading zeros survive); ``types`` coerces per
    value with try_cast."""
    found = file_heads(spark, path, None)
    if any(odd for _, _, odd in found) and not infer and len({header for _, header, _ in found}) == 1:
        names = next(pycsv.reader(io.StringIO(found[0][1])))
        df = read_quoted(spark, [path for path, _, _ in found], _strings(names)).drop("_file")
    else:
        # types are inferred from whole records, so such a file is read by one task
        many = any(odd for _, _, odd in found)
        df = spark.read.options(**DIALECT, inferSchema=infer, multiLine=many).csv(path)
    if na_compat:
        df = _na_to_null(df)
    return coerce_types(df, types) if types else df


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """(value, path, blk): every line with its file and the start of its split."""
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    return r.text(paths).select("value", F.col("_metadata.file_path").alias("path"),
                                F.col("_metadata.file_block_start").alias("blk"))


def file_heads(spark: SparkSession, root: str | Sequence[str], glob: str | None = "*.csv") -> list[tuple[str, str, bool]]:
    """(path, first line, whether a quoted field holds a newline) per file, by
    one scan; one row per file reaches the driver."""
    lines = _lines(spark, root, glob).withColumn("mid", F.monotonically_increasing_id())
    head = F.min_by("value", F.when(F.col("blk") == 0, F.col("mid")))
    found = lines.groupBy("path").agg(head.alias("header"), F.bool_or(_quotes(F.col("value")) % 2 == 1).alias("odd"))
    return sorted((r["path"], r["header"], bool(r["odd"])) for r in found.collect())


def placed_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(value, path, blk, line, odd, before): every line with its number in its
    split and the number of odd lines before it in the file."""
    own = _lines(spark, paths).withColumn("odd", (_quotes(F.col("value")) % 2).cast("long"))
    schema = "value string, path string, blk long, odd long, line long, in_split long"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, line, seen = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            blk, odd = b.column(2).to_numpy(), b.column(3).to_numpy()
            file = pc.dictionary_encode(b.column(1)).indices.to_numpy()
            new = np.append(True, (blk[1:] != blk[:-1]) | (file[1:] != file[:-1]))
            first = (b.column(1)[0].as_py(), int(blk[0]))
            if first != last:
                line = seen = 0
            starts = np.flatnonzero(new)
            part = np.cumsum(new) - 1
            running = np.cumsum(odd) - odd
            lines = np.arange(len(blk)) - starts[part] + np.where(part == 0, line, 0)
            before = running - running[starts][part] + np.where(part == 0, seen, 0)
            last = (b.column(1)[len(blk) - 1].as_py(), int(blk[-1]))
            line, seen = int(lines[-1]) + 1, int(before[-1] + odd[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lines), pa.array(before)],
                                             names=["value", "path", "blk", "odd", "line", "in_split"])

    # one row per split
    splits = own.groupBy("path", "blk").agg(F.sum("odd").alias("n"))
    ahead = Window.partitionBy("path").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("path").alias("s_path"), F.col("blk").alias("s_blk"),
                           F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    return (own.mapInArrow(run, schema)
            .join(splits, (F.col("path") == F.col("s_path")) & (F.col("blk") == F.col("s_blk")))
            .select("value", "path", "blk", "line", "odd", (F.col("in_split") + F.col("ahead")).alias("before")))


def read_quoted(spark: SparkSession, paths: Sequence[str], schema: T.StructType, options: Mapping | None = None) -> DataFrame:
    """Files with a header whose quoted fields may hold newlines, and ``_file``.

    The odd lines of a file open and close such fields in turn, so the lines of
    one record have the same ``before div 2``. Line ends inside a field are
    read as a newline; a quote that is never closed takes in the lines up to
    the next odd one."""
    lines = placed_lines(spark, paths).where((F.col("blk") > 0) | (F.col("line") > 0))
    inside = F.col("before") % 2 == 1
    whole = lines.where(~inside & (F.col("odd") == 0) & (F.col("value") != "")).select("path", F.col("value").alias("record"))
    pieces = (lines.where(inside | (F.col("odd") == 1))
              .groupBy("path", F.expr("before div 2").alias("nth"))
              .agg(F.array_sort(F.collect_list(F.struct("blk", "line", "value"))).alias("lines"))
              .select("path", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record")))
    own = {k: v for k, v in DIALECT.items() if k != "header"} | dict(options or {})
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    parsed = whole.unionByName(pieces).select(
        F.from_csv("record", ddl, own).alias("r"),
        F.element_at(F.split("path", "/"), -1).alias("_file"))
    return parsed.select("r.*", "_file")


def read_csv_union(
    spark: SparkSession,
    root: str,
    types: Mapping[str, T.DataType] | None = None,
    glob: str = "*.csv",
    na_compat: bool = False,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Every CSV under ``root`` (name order), grouped by header, unioned
    by column name (missing columns null), with ``_file`` (file name).
    Corrupt files are skipped with a warning (``ignoreCorruptFiles``);
    ``corrupt_col`` keeps the raw text of malformed rows in that column."""
    groups: dict[tuple[str, bool], list[str]] = {}
    for path, header, odd in file_heads(spark, root, glob):
        if header is None or header.strip() == "":
            log.warning("skipping %s: no header", path)
            continue
        groups.setdefault((header, odd), []).append(path)
    frames = []
    for (header, odd), paths in groups.items():
        names = next(pycsv.reader(io.StringIO(header)))
        if len(set(names)) != len(names):
            log.warning("skipping %d files with duplicate header names: %s", len(paths), names)
            continue
        schema = _strings(names + ([corrupt_col] if corrupt_col else []))
        extra = {"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {}
        if odd:
            frames.append(read_quoted(spark, paths, schema, extra))
            continue
        r = spark.read.options(**DIALECT, **extra).option("ignoreCorruptFiles", True)
        frames.append(r.schema(schema).csv(paths).withColumn("_file", F.col("_metadata.file_name")))
    if not frames:
        raise FileNotFoundError(f"no readable CSV files under {root}")
    out = union_by_name(frames)
    if na_compat:
        out = _na_to_null(out, keep_cols=("_file",))
    return coerce_types(out, types) if types else out


def read_filings(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Merged filings CSVs + ``filing_type`` = text before the first '_'
    of the file stem (10-K, 10-Q, 8-K)."""
    df = read_csv_union(spark, root, glob=glob)
    return df.withColumn("filing_type", file_prefix(F.col("_file"))).drop("_file")
