"""From raw documents to token files: toxic documents go, one document of each
group of near copies stays, documents that hold a benchmark item go, the rest
is mixed to target weights and written as token ids in that order.

Every stage takes what the one before it kept, read back from Parquet. A stage
that only orders its rows (the mixture) says so by the order of the rows in its
files; the last stage takes the order from there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortbook.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from shortbook.llm.common import stored, table
from shortbook.session import scratch_dir

# near copies: five words a shingle, similarity in percent
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go; those without a
    letter, a null text among them, score 0 and stay."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays;
    documents without words or without an id stay."""
    found = jaccard_join.similar_sets(docs, size=SHINGLE, percent=PERCENT)
    gone = stored(found.filter("n_shingles > 0 and doc_id != component_id").select("doc_id").distinct(), "near-copies")
    return docs.alias("own").join(gone.alias("gone"), F.col("own.doc_id").cast("long") == F.col("gone.doc_id"),
                                  "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; a null text holds none."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted by their place in the mixture: the files, by their
    number, and the rows in them are the order. Null sources are one source; a
    null or non-positive volume counts as 1."""
    into = "mix" + "_" * max(map(len, docs.columns))  # a name that no column has
    mixed = mixing.mix(docs, into=into)
    return (mixed.orderBy(f"{into}.slot", "source", f"{into}.place")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order in which ``docs`` stands in its files, or by
    doc_id if it does not come from files; the result is read back from them,
    one row per document."""
    path = scratch_dir(spark, "mixed-tokens")
    token_files.write_tokens(docs, path, order=_file_order(docs))
    return token_files.read_documents(spark, path)


def _file_order(docs: DataFrame) -> list | None:
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
    order = [number.try_cast("long"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return None
    return order


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_sources", mix_sources),
    ("token_files", write_tokens),
]

# a trained network decides in the first stage, and a tokenizer in the last
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn; what it returns is written to the shared folder
    and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
