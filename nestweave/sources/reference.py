"""Reference data: parts of a snapshot put together, or rows read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.functions.nested import column

# Longest list of keys that is sent to a database as an IN list.
MAX_PUSHED_KEYS = 1_000


# Fixed value: the version that marks a UUID as made by rules of its own, from a digest here.
_UUID_VERSION = "8"


def reference_snapshot(
    parts: Sequence[DataFrame], surrogate_key: str | None = None, named: bool = False
) -> DataFrame:
    """The distinct rows of all parts, optionally with a UUID column.

    The UUID is random, or with ``named`` the one that :func:`row_uuid` gives the row: a retried task
    and a second reading give the same. Copies collapse on the map side before the shuffle.
    """
    snapshot = reduce(DataFrame.unionByName, parts).dropDuplicates()
    if surrogate_key is None:
        return snapshot
    key = row_uuid([column(c) for c in snapshot.columns]) if named else F.expr("uuid()")
    return snapshot.select(key.alias(surrogate_key), "*")


def row_uuid(columns: Sequence[Column]) -> Column:
    """A UUID in the layout of RFC 9562, version 8, whose other bits are from a SHA-256 of the columns.

    Equal values give equal keys wherever and whenever they are computed. Columns are written as strings,
    each with its length before it, and a null as ``-``, so that no two rows are written alike.
    """

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.sha2(F.concat_ws(",", *[written(c) for c in columns]), 256)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    parts = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit(_UUID_VERSION), F.substring(digest, 14, 3))]
    parts += [F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.concat_ws("-", *parts)


class BucketedReference:
    """Names of several domains in a table bucketed and sorted by (domain, id), as batches meet them.

    A batch brings its ids to the buckets; the reference side is read where it lies and never moves, neither for the
    join nor for choosing the last name. An append stores one row per id of what it is given, the last
    in ``order``, so an id that very many rows have is one row a task before it moves and one row an
    append afterwards. Appends may be repeated.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str,
        domains: Mapping[str, tuple[str, str]],
        order: Sequence[str],
        buckets: int = 200,
        id_type: str = "string",
    ):
        """``domains`` maps a domain to its id and name columns in the wide reference; ids are cast to ``id_type``."""
        self.spark, self.table, self.domains, self.order = spark, table, dict(domains), list(order)
        self.buckets, self.id_type = buckets, id_type

    def append(self, reference: DataFrame) -> None:
        """Adds the names in ``reference`` to the table, which the first append creates."""
        entries = [
            F.when(
                column(i).isNotNull(),
                F.struct(F.lit(d).alias("domain"), column(i).cast(self.id_type).alias("id"), column(n).alias("name")),
            )
            for d, (i, n) in self.domains.items()
        ]
        ranks = F.struct(*[column(c).alias(f"order_{i}") for i, c in enumerate(self.order)])
        rows = reference.select(ranks.alias("rank"), F.explode(F.array_compact(F.array(*entries))).alias("entry"))
        last = F.max(F.struct("rank", "entry.name")).alias("last")
        chosen = rows.groupBy("entry.domain", "entry.id").agg(last).select("domain", "id", "last.rank", "last.name")
        dealt = chosen.repartition(self.buckets, "domain", "id")
        writer = dealt.write.bucketBy(self.buckets, "domain", "id").sortBy("domain", "id")
        writer.format("parquet").option("compression", "zstd").mode("append").saveAsTable(self.table)

    def names(self, keys: DataFrame) -> DataFrame:
        """(domain, id, name) of the ids in ``keys`` (domain, id), each once."""
        found = self.spark.table(self.table).join(keys.select("domain", "id"), ["domain", "id"], "left_semi")
        last = F.max_by("name", F.struct("rank", "name"))
        return found.groupBy("domain", "id").agg(last.alias("name"))


def reference_by_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    key: str | None = None,
    keys: Sequence[object] | None = None,
    fetch_size: int = 100_000,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Reads ``columns`` of a database table; Spark pushes the projection and the keys down.

    ``keys`` is for a list known to the caller: a short one is sent to the database, a longer one is
    joined after the read. To cut a large table to the ids of a batch,
    read it with a partition column, which splits the read over the executors, and use
    :func:`nestweave.operators.keys.key_pruned_reference`.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    rows = reader.options(**options).load()
    if keys is not None:
        if key is None:
            raise ValueError("keys need the name of their column")
        if len(keys) <= MAX_PUSHED_KEYS:
            rows = rows.where(F.col(key).isin(list(keys)))
        else:
            wanted = spark.createDataFrame([(k,) for k in keys], rows.select(key).schema)
            rows = rows.join(wanted, key, "left_semi")
    return rows.select(*columns)
