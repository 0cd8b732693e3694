"""Sizes of id sets and their overlap with dimensions from sketches that are kept and merged.

A theta sketch of a set of ids has a fixed size however large the set is. Sketches of batches, stored one row a
domain and batch, merge to the sketch of all of them, and the sketch of a dimension tells how many of the ids it
names. With 2^14 entries an estimate is off by less than 1.6 % in 19 of 20 cases; small sets are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.functions.nested import column, nested_ids
from nestweave.sources.partitions import PartitionedFolder
from nestweave.streaming.enrichment import BATCH

#: Binary logarithm of the entries of a sketch, which takes 128 KB at most.
LOG_ENTRIES = 14
#: Share of a dimension's ids in use up to which it pays to cut it to them first.
WORTH = 0.5

_SCHEMA = "domain string, sketch binary, n long"


def id_sketches(docs: DataFrame, id_fields: Mapping[str, str], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(domain, sketch, n) of the ids of several arrays, the domain named like its array; one pass, no distinct.

    ``n`` counts all ids, repeats included; nulls and null arrays are left out.
    """

    def tagged(array: str, id_field: str) -> Column:
        ids = nested_ids(array, id_field).cast("array<string>")
        return F.transform(ids, lambda x: F.struct(F.lit(array).alias("domain"), x.alias("id")))

    every = F.array_compact(F.array(*[tagged(*item) for item in id_fields.items()]))
    ids = docs.select(F.explode(F.flatten(every)).alias("key")).select("key.*").where("id IS NOT NULL")
    return ids.groupBy("domain").agg(F.theta_sketch_agg("id", log_entries).alias("sketch"), F.count("*").alias("n"))


def dimension_sketches(dimensions: Mapping[str, tuple[DataFrame, str]], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(domain, sketch, n) of dimensions, each with its id column."""
    rows = [
        d.select(F.lit(domain).alias("domain"), column(id_column).cast("string").alias("id"))
        for domain, (d, id_column) in dimensions.items()
    ]
    ids = reduce(DataFrame.unionByName, rows).where("id IS NOT NULL")
    return ids.groupBy("domain").agg(F.theta_sketch_agg("id", log_entries).alias("sketch"), F.count("*").alias("n"))


def merged(sketches: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """One row per domain for all parts in ``sketches`` (domain, sketch, n)."""
    return sketches.groupBy("domain").agg(F.theta_union_agg("sketch", log_entries).alias("sketch"), F.sum("n").alias("n"))


def overlap_estimates(ids: DataFrame, dimensions: DataFrame) -> DataFrame:
    """(domain, ids, dimension_ids, found), all estimates: different ids, those of the dimension, and those in both."""
    known = dimensions.select("domain", F.col("sketch").alias("known"))
    both = ids.select("domain", "sketch").join(known, "domain", "left")
    found = F.theta_sketch_estimate(F.theta_intersection("sketch", "known"))
    return both.select(
        "domain",
        F.theta_sketch_estimate("sketch").alias("ids"),
        F.coalesce(F.theta_sketch_estimate("known"), F.lit(0)).alias("dimension_ids"),
        F.coalesce(found, F.lit(0)).alias("found"),
    )


def worth_pruning(estimates: DataFrame, at_most: float = WORTH) -> dict[str, bool]:
    """Whether a domain uses so few of its dimension's ids that cutting it first pays
    (:func:`nestweave.operators.lookup.prune_dimensions`), without a pass over either."""
    return {r.domain: r.found <= at_most * r.dimension_ids for r in estimates.collect()}


class SketchLog:
    """A folder with the sketches of every micro-batch; a replayed batch leaves the same behind."""

    def __init__(self, spark: SparkSession, path: str, id_fields: Mapping[str, str], log_entries: int = LOG_ENTRIES):
        self.id_fields, self.log_entries = dict(id_fields), log_entries
        self.folder = PartitionedFolder(spark, path, f"{_SCHEMA}, {BATCH} long", BATCH)

    def record(self, batch: DataFrame, batch_id: int) -> None:
        rows = id_sketches(batch, self.id_fields, self.log_entries)
        self.folder.replace(rows.withColumn(BATCH, F.lit(batch_id).cast("long")))

    def total(self, batches: Sequence[int] | None = None) -> DataFrame:
        """(domain, sketch, n) of all batches, or of some."""
        rows = self.folder.rows()
        rows = rows if batches is None else rows.where(F.col(BATCH).isin(list(batches)))
        return merged(rows.drop(BATCH), self.log_entries)
