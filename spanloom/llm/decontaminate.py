"""Benchmark decontamination: short test items found inside long documents by size-partitioned MinHash containment search.

Items are partitioned by size class. A class whose items are no longer than a sketch keeps all their hashes and its cut is exact;
the others keep the least hashes of an item (a bottom-k MinHash), with a cut that follows from the threshold and a stated chance of
a miss. A document's shingles are looked up among the sketches; the share found estimates how much of the item the document
contains, however long it is. A document whose size class is below what an item needs can't contain it and leaves its pair
early. What is left is verified by exact shingles.
"""

from __future__ import annotations

from math import ceil, exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, let, small_side, stored, word_array

WIDTH = 5
THRESHOLD = 0.8
#: Hashes of a sketch at least; lower thresholds take more.
SKETCH = 16
#: The greatest chance that a pair at the threshold isn't looked at.
MISS = 1e-6


def sketch_size(threshold: float) -> int:
    """Hashes a sketch needs so that a pair at the threshold shares one of them but for a chance of MISS."""
    return max(SKETCH, ceil(log(1 / MISS) / -log(1 - threshold)) if threshold < 1 else SKETCH)


def least_hits(n: int, threshold: float) -> int:
    """The greatest number of ``n`` sampled hashes that a pair at the threshold shares but for a chance of MISS.

    By Chernoff's bound, which holds for draws without replacement too.
    """

    def below(hits: int) -> float:  # a bound of the chance of fewer than ``hits``
        a = (hits - 1) / n
        apart = (a * log(a / threshold) if a else 0.0) + ((1 - a) * log((1 - a) / (1 - threshold)) if a < 1 else 0.0)
        return exp(-n * apart)

    return n if threshold >= 1 else max([1, *(k for k in range(1, int(n * threshold) + 1) if below(k) <= MISS)])


def shingle_hashes(words: Column) -> Column:
    """XXH64 of each run of WIDTH words, repeats included; of all words if they are fewer; none without words."""
    one = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - WIDTH, F.lit(0))), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WIDTH))))
    return let(words, lambda w: F.when(F.size(w) > 0, one(w)).otherwise(F.array().cast("array<bigint>")))


def shingle_texts(words: Column) -> Column:
    """The distinct runs of WIDTH words, joined by spaces; all words if they are fewer; none without words."""
    one = lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - WIDTH + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, WIDTH), " ")))
    return let(words, lambda w: F.when(F.size(w) > 0, one(w)).otherwise(F.array().cast("array<string>")))


def size_class(n: Column) -> Column:
    """0 for one shingle, else the whole part of the binary logarithm."""
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, h, least_class, cut) for items (item_id, words): an item's rows together, a hash at a time.

    least_class is the size class a document needs to hold ``threshold`` of the item, cut the hashes it must share.
    """
    most = sketch_size(threshold)
    hashed = items.select("item_id", F.explode(shingle_hashes(F.col("words"))).alias("h")).distinct()
    whole = hashed.groupBy("item_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("h")).alias("hs"))
    needed = F.ceil(F.col("n") * float(threshold) - 1e-9)
    cut = F.when(F.col("n") <= most, needed).otherwise(F.lit(least_hits(most, threshold))).cast("int")
    return whole.select("item_id", size_class(needed).alias("least_class"), cut.alias("cut"), F.explode(F.slice("hs", 1, most)).alias("h"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): the documents that contain at least ``threshold`` of an item's distinct
    shingles of five lower-cased words. A pair at the threshold is missed with a chance of MISS at most; no other pair is told.

    An item or document of fewer than five words has one shingle, all its words; one without words has none and is in no pair.
    Rows with equal ids are taken as one document or item, their shingles together; null ids form no pair. An item that a
    document holds several times counts once. Empty tables give an empty result; other columns are ignored.
    """
    texts = id_text(docs, id_col, text_col).filter("doc_id is not null")
    own = benchmark.select(F.col(item_col).cast("long").alias("item_id"), word_array(F.lower(F.col(item_text_col).cast("string"))).alias("words")).filter("item_id is not null and size(words) > 0")
    items = stored(own.select("item_id", "words"), "items")
    shingles = stored(items.select("item_id", F.explode(shingle_texts(F.col("words"))).alias("shingle")).distinct(), "itemshingles")
    sketch = stored(sketches(items, threshold), "sketches")
    n_sketch = sketch.count()

    hashed = texts.select("doc_id", shingle_hashes(word_array(F.lower("text"))).alias("hs"))
    looked = hashed.select("doc_id", size_class(F.size("hs")).alias("doc_class"), F.explode("hs").alias("h"))
    # the shingles of an id's rows count together, so a row's own size tells nothing where an id has several
    again = stored(texts.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("several")), "again")
    found = looked.join(small_side(sketch, n_sketch), "h").join(small_side(again, again.count()), "doc_id", "left").filter("several or doc_class >= least_class")
    hits = found.groupBy("doc_id", "item_id", "cut").agg(F.size(F.collect_set("h")).alias("hits"))
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_item"))
    candidates = stored(hits.filter("hits >= cut").select("doc_id", "item_id").join(sizes, "item_id"), "candidates")

    wanted = candidates.select("doc_id").distinct()
    wanted = small_side(wanted, candidates.count())
    exact = texts.join(wanted, "doc_id", "left_semi").select("doc_id", F.explode(shingle_texts(word_array(F.lower("text")))).alias("shingle"))
    size = shingles.agg(F.count("*").alias("n"), F.sum(F.octet_length("shingle")).alias("bytes")).first()
    shared = exact.join(small_side(shingles, size["n"], size["bytes"] or 0), "shingle").distinct().join(candidates, ["doc_id", "item_id"])
    counted = shared.groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    return counted.filter(F.col("n_shared") >= F.col("n_item") * float(threshold)).select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item. Rows that share an id go together; a row without an id goes by its own text."""
    leaks = stored(find_leaks(docs, benchmark, threshold, id_col, text_col).select("doc_id").distinct(), "leaks")
    kept = docs.join(small_side(leaks.withColumnRenamed("doc_id", id_col), leaks.count()), id_col, "left_anti").select(docs.columns)
    nameless = docs.filter(F.col(id_col).isNull())
    if nameless.isEmpty():
        return kept
    by_text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    texts = nameless.select(by_text.alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropDuplicates(["doc_id"])
    found = stored(find_leaks(texts, benchmark, threshold).select(F.col("doc_id").alias("__h")).distinct(), "leaks")
    clean = nameless.withColumn("__h", by_text).join(small_side(found, found.count()), "__h", "left_anti").select(docs.columns)
    return kept.filter(F.col(id_col).isNotNull()).unionByName(clean)
