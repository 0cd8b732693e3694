"""What the operators share: reading documents, written intermediate tables, hot keys, components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.session import shared_folder

#: ASCII white space as the contracts define it, for Java's and DuckDB's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"

#: A key is hot above this share of all rows, so at most HOT_SHARE keys are, whatever the data.
HOT_SHARE = 1000
HOT_FLOOR = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``; a null text counts as empty, other columns are left out."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].alias("doc_id"), text.alias("text"))


def text_hash(text: Column) -> Column:
    """With a ``doc_id`` the name of a row: rows that repeat an id are told apart by it; null counts as empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def words(text: Column) -> Column:
    """The words of a text, ASCII white space between them, as an array without empty strings."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    The lineage ends at the files: what a lost executor had computed is read again instead of
    computed again, and jobs that use the rows several times compute them once.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, count: str, merge: bool = False) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per key and its size.

    A group above ``1 / HOT_SHARE`` of all rows is joined by broadcast, and there are fewer than
    HOT_SHARE of those by construction; the others meet by a shuffle on the key, or as Spark finds best for
    their size unless ``merge`` is set. Every key of ``rows`` must be in ``groups``.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    limit = max(HOT_FLOOR, total // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col(count) > limit))
    rest = groups.where(F.col(count) <= limit)
    cold = rows.join(hot, key, "left_anti").join(rest.hint("merge") if merge else rest, key)
    return cold.unionByName(rows.join(hot, key))


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``pairs``: the smallest node that can be reached.

    Every round takes the smallest root among the neighbours and then the root of that root, so
    the rounds grow with the logarithm of the longest chain. Nothing but the number of changed
    rows reaches the driver. Each round is written, which cuts the lineage.
    """
    one = pairs.select(F.col(a).alias("node"), F.col(b).alias("other"))
    two = pairs.select(F.col(b).alias("node"), F.col(a).alias("other"))
    links = written(one.unionByName(two).distinct(), "links")
    roots = written(
        links.groupBy("node").agg(F.min("other").alias("root"))
        .select("node", F.least("node", "root").alias("root")),
        "roots",
    )
    while True:
        seen = links.join(roots.withColumnRenamed("node", "other"), "other")
        near = seen.groupBy("node").agg(F.min("root").alias("near"))
        moved = roots.join(near, "node").select(
            "node", F.least("root", "near").alias("root"), F.col("root").alias("was")
        )
        moved = written(moved, "roots")
        if moved.where("root <> was").isEmpty():
            return moved.select("node", "root")
        above = moved.where("root <> node").select(
            F.col("node").alias("root"), F.col("root").alias("above")
        )
        jumped = moved.join(above, "root", "left")
        roots = written(
            jumped.select("node", F.coalesce("above", "root").alias("root")), "roots"
        )


def each_row(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch one by one, so that only one text at a time is a Python string."""
    return (tuple(x.as_py() for x in row) for row in zip(*batch.columns, strict=True))


def small(rows: DataFrame, row_bytes: int, limit: int = 16 << 20) -> DataFrame:
    """``rows``, marked for broadcast if they are counted to be below ``limit`` bytes.

    ``rows`` should be written or cheap. Larger ones are left to Spark, which shuffles both sides.
    """
    return F.broadcast(rows) if rows.count() * row_bytes <= limit else rows
