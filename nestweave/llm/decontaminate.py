"""Benchmark decontamination (7): size-partitioned MinHash containment search, in built-in functions.

An item is *contained* in a document that has at least ``CONTAINED`` of the item's different
five-word shingles. Documents are far longer than items, so the sketches are made for containment:
items are partitioned by size, and all items of a partition keep as many smallest shingle hashes as
make sure that a document that contains the item has at least one of them (a fifth of the
partition's upper bound, and one). The documents' hashes join the sketches, documents too short for the item
are passed over, and what is found is verified by the exact shingles. No contained item is missed.

Defined results: words are compared in lower case; a text of fewer than five words is one shingle; null or
empty items and documents contain nothing and are in nothing; items with the same text are each
reported; rows that repeat a ``doc_id`` count as one document; rows without ``doc_id`` or ``item_id``
are passed over; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import small, words, written

SHINGLE = 5
CONTAINED = 0.8


def _shingled(rows: DataFrame, one) -> DataFrame:
    """``rows`` (id, text) with ``shingles``: ``one`` of each five words, or of all if they are fewer."""
    # What is made here is exploded by explode_outer: for a plain explode Spark filters for arrays that are
    # not empty first, and would make the words anew for every element of that filter's expression.
    rows = rows.withColumn("words", words(F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    n = F.size("words")
    places = F.sequence(F.lit(0), n - SHINGLE)
    every = F.transform(places, lambda i: one([F.get("words", i + j) for j in range(SHINGLE)]))
    few = F.array(one([F.array_join("words", " ")]))
    none = F.filter(few, lambda x: F.lit(False))
    return rows.withColumn("shingles", F.when(n >= SHINGLE, every).when(n > 0, few).otherwise(none)).drop("words", "text")


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def needed(size: Column, contained: float = CONTAINED) -> Column:
    """How many of ``size`` shingles a document must have, in whole numbers to keep off rounding."""
    percent = F.lit(round(contained * 100))
    return F.ceil((size * percent) / 100).cast("int")


def sketches(items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(hash, item_id, need): the smallest hashes of every item, as many as its size partition needs."""
    rows = items.select("item_id", "text").where(F.col("item_id").isNotNull())
    rows = _shingled(rows, _hash).withColumn("hashes", F.array_sort(F.array_distinct("shingles")))
    rows = rows.where(F.size("hashes") > 0).withColumn("size", F.size("hashes"))
    bound = F.pow(F.lit(2.0), F.ceil(F.log2("size"))).cast("int")
    # Of an item that is contained, at most a fifth of the hashes is absent; one more is present.
    keep = F.floor(bound * round((1 - contained) * 100) / 100) + 1
    return rows.select(
        F.explode_outer(F.slice("hashes", F.lit(1), F.least(keep.cast("int"), F.col("size")))).alias("hash"),
        "item_id",
        needed(F.col("size"), contained).alias("need"),
    )


def find_contained(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of every document and item it contains."""
    own = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    keys = small(written(sketches(items, contained), "sketches"), 32)
    hashed = _shingled(own, _hash).withColumn("n", F.size("shingles"))
    candidates = hashed.select("doc_id", "n", F.explode_outer("shingles").alias("hash")).join(keys, "hash")
    candidates = candidates.where(F.col("n") >= F.col("need")).select("doc_id", "item_id").distinct()
    candidates = written(candidates, "candidates")

    asked = items.select("item_id", "text").where(F.col("item_id").isNotNull())
    asked = _shingled(asked, _text).withColumn("shingles", F.array_distinct("shingles"))
    asked = asked.select("item_id", F.size("shingles").alias("n_shingles"), F.explode_outer("shingles").alias("shingle"))
    asked = small(written(asked, "item-shingles"), 128)
    some = small(candidates.select("doc_id").distinct(), 8)
    exact = _shingled(own.join(some, "doc_id", "left_semi"), _text)
    exact = exact.select("doc_id", F.explode_outer(F.array_distinct("shingles")).alias("shingle"))
    shared = exact.join(asked, "shingle").select("doc_id", "item_id", "n_shingles", "shingle").distinct()
    found = shared.groupBy("doc_id", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    found = found.join(candidates, ["doc_id", "item_id"], "left_semi")
    found = found.where(F.col("n_shared") >= needed(F.col("n_shingles"), contained))
    return found.select(
        "doc_id", "item_id", "n_shared", F.col("n_shingles").cast("long").alias("n_shingles"),
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )
