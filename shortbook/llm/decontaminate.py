"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents become sets of five-word shingles. An item is contained in
a document that has at least 80 % of the item's shingles. Items are short and
documents long, so the Jaccard similarity of a match is tiny and banded
signatures would lose it; the sketch is therefore sized by the item alone.
Items are partitioned by size class, and each keeps its lowest MinHash values:
one more than a match may miss, plus ``SPARE`` by class. A containing document
must have at least 1 + spare of them, so no match is lost. Every size class has
its own bound, the highest value of its sketches: a document is looked up with
those of its shingles that lie below the bound of a class whose items are not
too large for it. The values of a class with few of them are matched one by one
instead, so that a handful of very short items does not raise any bound. The few
candidates are verified on the exact shingles.

Everything is built from DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shortbook.llm.common import stored, table, text_of

SHINGLE = 5
PERCENT = 80
# hash values of a sketch beyond the ones a match may miss, by size class:
# items below each bound of shingles; more of them leave fewer false candidates
SPARE = [(8, 0), (32, 1), (128, 2)]
SPARE_LARGE = 3
# items beyond the last bound fall into classes that grow by this factor
CLASS_GROWTH = 4
# a class with no more sketch values than these is matched by its values
LISTED_VALUES = 1_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text_of(text)), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _gram(words: str, make: str) -> Column:
    """``make`` over the shingles of an array column; fewer than five words are
    one shingle, no word is none."""
    places = ", ".join(f"get({words}, i + {k})" for k in range(SHINGLE))
    return F.expr(
        f"case when size({words}) = 0 then array() "
        f"when size({words}) < {SHINGLE} then array({make}(array_join({words}, ' '))) "
        f"else array_distinct(transform(sequence(0, size({words}) - {SHINGLE}), i -> "
        + (f"xxhash64({places})" if make == "xxhash64" else f"concat_ws(' ', {places})") + ")) end")


def shingle_hashes(words: str) -> Column:
    return _gram(words, "xxhash64")


def shingles(words: str) -> Column:
    return _gram(words, "string")


def item_sketches(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_id, n, need, grams, sketch): the sketch is the array of the item's
    lowest hashes, ``need`` the least number of them in a containing document."""
    spare = F.lit(SPARE_LARGE)
    for bound, value in reversed(SPARE):
        spare = F.when(F.col("n") < bound, value).otherwise(spare)
    return (items.select(F.col("item_id"), words_of(F.col("text")).alias("w"))
            .select("item_id", shingles("w").alias("grams"), F.array_sort(shingle_hashes("w")).alias("hashes"))
            .filter(F.size("grams") > 0).distinct()
            .withColumn("n", F.size("grams"))
            .withColumn("missable", F.expr(f"n - int(ceil(n * {percent} / 100.0))"))
            .withColumn("size_sketch", F.least(F.size("hashes"), F.col("missable") + 1 + spare))
            .select("item_id", "n", "grams", F.expr("slice(hashes, 1, size_sketch)").alias("sketch"),
                    (F.col("size_sketch") - F.col("missable")).alias("need")))


def size_class(n: Column) -> Column:
    """Number of the size class: one each below the bounds of ``SPARE``, then
    by powers of ``CLASS_GROWTH``."""
    last = SPARE[-1][0]
    out = F.floor(F.log(float(CLASS_GROWTH), n / F.lit(last)) + 1e-9).cast("int") + len(SPARE)
    for k, (bound, _) in reversed(list(enumerate(SPARE))):
        out = F.when(n < bound, k).otherwise(out)
    return out


def probe_filter(sketches: DataFrame, percent: int, listed_values: int) -> tuple[Column, list[int]] | None:
    """What a document of ``held`` shingles is looked up with: hashes up to a
    bound, and a list of hashes. One row a size class reaches the driver, and
    the values of the classes that have at most ``listed_values``. None without
    an item."""
    classes = (sketches.groupBy(size_class(F.col("n")).alias("class"))
               .agg(F.min("n").alias("least"), F.max(F.expr("array_max(sketch)")).alias("top"),
                    F.sum(F.size("sketch")).alias("values")).collect())
    if not classes:
        return None
    few = [c["class"] for c in classes if c["values"] <= listed_values]
    listed = (sketches.filter(size_class(F.col("n")).isin(few)).select(F.explode("sketch").alias("hash"))
              .distinct().collect()) if few else []
    lowest = F.lit(-(1 << 63))
    bounds = [F.when(100 * F.col("held") >= percent * c.least, F.lit(c.top)).otherwise(lowest)
              for c in classes if c["class"] not in few]
    return F.greatest(lowest, lowest, *bounds), [r.hash for r in listed]


def contamination(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) of every item held
    by a document to ``percent`` or more.

    A document or item without a word matches nothing; one with fewer than
    five words has its whole word sequence as its only shingle. Repeated rows
    (same id and text) report once, as do repeated items; null ids are ids;
    other columns are not read; empty tables give no rows.
    """
    return (held_items(docs, items, percent)
            .groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_common").alias("n_common"))
            .withColumn("containment", F.col("n_common") / F.col("n_shingles")))


def held_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, copy, item_id, n_shingles, n_common); ``copy`` is a hash of the text."""
    sketches = stored(item_sketches(items.select(F.col("item_id").cast("long"), "text"), percent),
                      "item-sketches")
    probes = probe_filter(sketches, percent, LISTED_VALUES)
    if probes is None:
        return _result(docs.sparkSession)
    bound, listed = probes
    probe = sketches.select("item_id", "n", "need", F.explode("sketch").alias("hash"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64(text_of(F.col("text"))).alias("copy"), text_of(F.col("text")).alias("text"))
    hits = (own.select("doc_id", "copy", words_of(F.col("text")).alias("w"))
            .select("doc_id", "copy", shingle_hashes("w").alias("hashes"))
            .withColumn("held", F.size("hashes")).withColumn("bound", bound)
            .select("doc_id", "copy", "held",
                    F.explode(F.filter("hashes", lambda h: (h <= F.col("bound")) | h.isin(listed))).alias("hash"))
            .join(probe, "hash")
            .filter(100 * F.col("held") >= percent * F.col("n"))
            .groupBy("doc_id", "copy", "item_id")
            .agg(F.count_distinct("hash").alias("found"), F.first("need").alias("need"))
            .filter(F.col("found") >= F.col("need"))
            .select(F.col("doc_id").alias("c_doc"), F.col("copy").alias("c_copy"), "item_id"))
    # written once: its real size tells Catalyst whether it can be sent to the documents
    candidates = stored(hits, "candidates")
    wanted = candidates.select("c_doc", "c_copy").distinct()
    held = (own.join(wanted, (F.col("copy") == F.col("c_copy")) & F.col("doc_id").eqNullSafe(F.col("c_doc")),
                     "left_semi")
            .dropDuplicates(["doc_id", "copy"])
            .select("doc_id", "copy", words_of(F.col("text")).alias("w"))
            .select("doc_id", "copy", shingles("w").alias("held")))
    exact = sketches.select(F.col("item_id").alias("of_item"), "n", "grams")
    return (held.join(candidates, (F.col("copy") == F.col("c_copy"))
                      & F.col("doc_id").eqNullSafe(F.col("c_doc")))
            .join(exact, F.col("item_id").eqNullSafe(F.col("of_item")))
            .select("doc_id", "copy", "item_id", F.col("n").cast("long").alias("n_shingles"),
                    F.size(F.array_intersect("held", "grams")).cast("long").alias("n_common"))
            .filter(100 * F.col("n_common") >= percent * F.col("n_shingles")))


def _result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "doc_id long, copy long, item_id long, n_shingles long, n_common long")


def remove_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    found = stored(held_items(docs, items, percent).select("doc_id", "copy").distinct(), "contaminated")
    own, gone = docs.alias("own"), found.alias("gone")
    return own.join(gone, F.col("own.doc_id").cast("long").eqNullSafe(F.col("gone.doc_id"))
                    & (F.xxhash64(text_of(F.col("own.text"))) == F.col("gone.copy")), "left_anti")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH i AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), d AS (
  SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), ig AS (
  SELECT DISTINCT item_id, w, array_to_string(list_slice(w, k, k + 4), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM i WHERE len(w) > 0)
), dg AS (
  SELECT DISTINCT doc_id, w, array_to_string(list_slice(w, k, k + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)
), n AS (
  SELECT item_id, w, count(*) AS n_shingles FROM ig GROUP BY item_id, w
), c AS (
  SELECT doc_id, ig.item_id, ig.w AS iw, dg.w AS dw, count(*) AS n_common FROM dg JOIN ig ON dg.g = ig.g GROUP BY ALL
)
SELECT doc_id, c.item_id, n_shingles, max(n_common) AS n_common,
       max(n_common) / n_shingles AS containment
FROM c JOIN n ON c.iw = n.w AND c.item_id IS NOT DISTINCT FROM n.item_id
WHERE 100 * n_common >= 80 * n_shingles GROUP BY doc_id, c.item_id, n_shingles
"""
