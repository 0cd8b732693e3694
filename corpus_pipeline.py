"""The corpus pipeline: toxicity, exact dedup, near-dedup, decontamination, packing, in this order.

Every stage takes what its predecessor kept, as Parquet, and all but the last return rows of
``documents`` with all their columns, whatever these are named.

A decision names a row by its ``doc_id`` and a hash of its text, so rows that repeat an id are told apart. Rows equal in
both are one document, of which exact dedup keeps one. A row without ``doc_id`` can't be named: it
passes the stages that decide by name. Null texts count as empty; empty and very long texts are rows like any other;
empty tables give empty tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm import decontaminate, exact_dedup, minhash, packing, simhash, toxicity
from nestweave.llm.common import components, read, small, text_hash, written
from nestweave.llm.queries import TOKENIZER


def _row(docs: DataFrame, name: str, value: Column) -> Column:
    return F.struct(docs["doc_id"].cast("long").alias("doc_id"), value.alias(name))


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows with a ``doc_id``, which is a struct of it and the hash of the text."""
    return docs.where("doc_id IS NOT NULL").select(_row(docs, "text_hash", text_hash(docs["text"])).alias("doc_id"), "text")


def _without(docs: DataFrame, gone: DataFrame, name: str, value: Column) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` and ``value`` are in ``gone`` (doc_id, ``name``)."""
    dropped = gone.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col(name)).alias("_row")).distinct()
    dropped = small(written(dropped, "dropped-rows"), 64)
    return docs.join(dropped, _row(docs, name, value) == dropped["_row"], "left_anti")


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; a score of exactly 0.5 is rejected.

    It judges every row by its text alone, a null or empty one by the model's bias.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(docs["text"], model) < 0.5)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest ``doc_id``.

    Of several rows with that id and text one stays, the least by all its columns. All empty texts are equal.
    """
    rows = written(exact_dedup.deduplicate(docs, exact_dedup.DigestIndex.create(spark)), "exact-copies")
    digest = exact_dedup.digest_of(docs["text"])
    kept = _without(docs, rows.where("doc_id IS NOT NULL AND NOT kept"), "digest", digest)
    again = rows.where("doc_id IS NOT NULL AND kept").groupBy("doc_id", "digest").count().where("count > 1")
    again = written(again.select(F.struct("doc_id", "digest").alias("_row")), "repeated-rows")
    if again.isEmpty():
        return kept
    repeated = _row(kept, "digest", exact_dedup.digest_of(kept["text"]))
    single = kept.join(again, repeated == again["_row"], "left_anti")
    # Equal rows combine before they move, however many there are. Maps and variants have no order.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    ordered = [F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    least = kept.join(again, repeated == again["_row"], "left_semi").groupBy(repeated.alias("_row"))
    least = least.agg(F.min_by(F.struct(*columns), F.struct(*ordered)).alias("_least"))
    return single.unionByName(least.select("_least.*"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near copies.

    Two link if their SimHash fingerprints differ in two bits or fewer (op10), or with a Jaccard of five-word
    shingles of 0.8 or more; groups are closed over chains of both, and the row with the smallest (doc_id, text_hash) stays.
    """
    group = F.struct(F.col("stays.doc_id").alias("doc_id"), F.col("stays.text_hash").alias("text_hash")).alias("label")
    alike = written(minhash.near_copies(docs).select(F.struct("doc_id", "text_hash").alias("row"), group), "alike")
    close = simhash.near_duplicates(_named(docs)).where("doc_id <> component_id")
    close = written(close.select(F.col("doc_id").alias("row"), F.col("component_id").alias("label")).distinct(), "close")
    close = close.unionByName(close.select(F.col("label").alias("row"), "label").distinct())
    # A group goes by its first row. Two with a row in common are one, and groups are few beside rows.
    met = alike.join(close.withColumnRenamed("label", "other"), "row").where("label <> other").select("label", "other").distinct()
    roots = small(written(components(written(met, "met-groups"), "label", "other"), "group-roots"), 64)
    every = alike.unionByName(close).join(roots, F.col("label") == F.col("node"), "left")
    gone = every.where(F.coalesce("root", "label") != F.col("row")).select("row.*")
    return _without(docs, gone, "text_hash", text_hash(docs["text"]))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; each row is judged by its own text."""
    found = decontaminate.find_contained(_named(docs), read(spark, sf_dir, "benchmark"))
    return _without(docs, found.select("doc_id.doc_id", "doc_id.text_hash"), "text_hash", text_hash(docs["text"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences; an empty text is its end id alone."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", keep_civil),
    ("exact dedup", keep_first_copies),
    ("near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", pack),
]

#: Learnt scores, tokenizers and packings are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it has written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
