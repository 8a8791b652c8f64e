"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]],
             schema: str) -> DataFrame:
    """Run ``fn`` on each Arrow batch of ``df`` (columns as Python lists in,
    columns as lists out). Batches are bounded in rows and bytes by the
    session's Arrow settings, so memory does not grow with the partition."""
    arrow_schema = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema)
        free_memory()

    return df.mapInArrow(run, schema)


def free_memory() -> None:
    """Give what a task has freed back to the system: Python workers outlive
    their tasks, and what they keep counts beside the next stage's."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: later
    jobs neither recompute it nor depend on the executors that made it, and
    Catalyst sees its real size when it picks join strategies."""
    path = f"{scratch_dir(df.sparkSession, name)}/{uuid.uuid4().hex[:8]}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of frames that are no
    longer referenced: it learns of them when both garbage collectors run."""
    for _ in range(2):  # the first turn only frees what holds them
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def text_of(col: Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(col.cast("string"), F.lit(""))
