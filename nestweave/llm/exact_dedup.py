"""Exact dedup (6): a persistent digest index, bucketed and sorted by digest.

The index is a catalogue table ``(digest, keep_id, batch)``, ``bucketBy`` and ``sortBy`` digest. A
batch is reduced to one row per digest, compared with the index by a sort-merge anti-join that
reads the index in its buckets without a shuffle, and its new digests are appended.

Defined results: a null text counts as empty; rows that repeat a ``doc_id`` with the same text are
one document and all get its answer; a row without ``doc_id`` never stays in place of one that has
it; an empty batch appends nothing; other columns are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm.common import SPACE, attach, texts, written
from nestweave.session import shared_folder


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def digest_of(text: Column) -> Column:
    """The SHA-256 of the normalised text; null counts as empty."""
    return F.unhex(F.sha2(normalised(F.coalesce(text.cast("string"), F.lit(""))), 256))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return texts(docs).select("doc_id", digest_of(F.col("text")).alias("digest"))


@dataclass(frozen=True)
class DigestIndex:
    """The index as a bucketed table of the catalogue, its files in the shared folder."""

    spark: SparkSession
    table: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, buckets: int = 64, path: str | None = None):
        table = f"digest_index_{uuid.uuid4().hex}"
        empty = spark.createDataFrame([], "digest binary, keep_id long, batch string")
        index = cls(spark, table, buckets)
        index._write(empty, path or shared_folder(spark, "digest-index"))
        return index

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _write(self, rows: DataFrame, path: str | None = None) -> None:
        writer = rows.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet")
        if path is not None:
            writer = writer.option("path", path)
        writer.mode("append").saveAsTable(self.table)

    def add(self, groups: DataFrame, batch: str) -> None:
        """Appends the digests of ``groups`` (digest, keep_id) that the index doesn't hold.

        A batch that is repeated after a failure finds its digests there and appends nothing.
        """
        known = self.rows().select("digest").hint("merge")
        fresh = groups.join(known, "digest", "left_anti")
        fresh = fresh.select("digest", F.col("keep_id").cast("long"), F.lit(batch).alias("batch"))
        # One task per bucket writes one sorted file per bucket.
        self._write(fresh.repartition(self.buckets, "digest"))


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str = "0") -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept) of every row of ``docs``; the index grows.

    ``keep_id`` is the document that stays of all batches so far, ``group_size`` counts the copies
    in this batch. Copies combine before the shuffle, and groups that hold many rows are broadcast.
    """
    rows = written(digests(docs), "digests")
    groups = written(
        rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "digest-groups",
    )
    index.add(groups, batch)
    kept = index.rows().select("digest", F.col("keep_id").alias("first_id")).hint("merge")
    sizes = groups.select("digest", "group_size")
    # A group of this batch whose digest is in the index keeps the document of the index.
    found = sizes.join(kept, "digest").withColumnRenamed("first_id", "keep_id")
    return attach(rows, found, "digest", "group_size").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))
    )
