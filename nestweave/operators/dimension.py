"""Reference dimensions: one name per id, and the in-memory form of a small one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.functions.nested import column
from nestweave.operators.prefilter import PREFILTER_BITS, key_bitmap, may_contain


def last_wins_dimension(
    reference: DataFrame, id_column: str, name_column: str, order: Sequence[str]
) -> DataFrame:
    """One row per id with the name of the last row in ``order``; ties go to the greater name.

    The aggregate combines on the map side, so an id with very many rows reaches the reducers as
    one row per map task. Its buffers are strings, so Spark sorts before it combines: cut a large
    reference to the ids in use first (:func:`chosen_names`), or keep the names from batch to
    batch (:mod:`nestweave.operators.maintained`).
    """
    rank = F.struct(*[column(c) for c in (*order, name_column)])
    return (
        reference.where(column(id_column).isNotNull())
        .groupBy(column(id_column).alias(id_column))
        .agg(F.max_by(column(name_column), rank).alias(name_column))
    )


def chosen_names(
    reference: DataFrame,
    domains: Mapping[str, tuple[str, str]],
    order: Sequence[str],
    keys: DataFrame,
    bits: int | None = PREFILTER_BITS,
) -> DataFrame:
    """(domain, id, name) of the ids in ``keys`` (domain, id), chosen as by last_wins_dimension.

    ``domains`` maps a domain to its id and name columns in the wide ``reference``, which is read
    once for all of them. A bitmap of the keys (:mod:`nestweave.operators.prefilter`) cuts it in
    the scan; the names of what passes are chosen with map-side combining, so an id with very many rows
    is one row a task before anything moves; the exact semi-join finds its rows partitioned by that aggregate.
    ``bits=None`` goes without the bitmap.
    """

    def entry(domain: str, id_column: str, name_column: str) -> Column:
        found = F.struct(
            F.lit(domain).alias("domain"), column(id_column).alias("id"), column(name_column).alias("name")
        )
        if bits is None:
            return F.when(column(id_column).isNotNull(), found)
        return F.when(may_contain(table, [F.lit(domain), column(id_column)], bits), found)

    table = None if bits is None else key_bitmap(keys, ["domain", "id"], bits).scalar()
    entries = F.array_compact(F.array(*[entry(d, i, n) for d, (i, n) in domains.items()]))
    ranks = [column(c).alias(f"order_{i}") for i, c in enumerate(order)]
    rows = reference.select(*ranks, F.explode(entries).alias("entry")).select(*[f"order_{i}" for i in range(len(order))], "entry.*")
    # The last rank of every name first: its buffer is a number, so rows combine in a hash table as they are read,
    # where a buffer with a string in it has them all sorted, and spilled, before any combine.
    rank = F.col("order_0") if len(order) == 1 else F.struct(*[f"order_{i}" for i in range(len(order))])
    named = rows.groupBy("domain", "id", "name").agg(F.max(rank).alias("rank"))
    chosen = named.groupBy("domain", "id").agg(F.max_by("name", F.struct("rank", "name")).alias("name"))
    return chosen.join(keys, ["domain", "id"], "left_semi")


def dimension_sizes(
    dimensions: Sequence[tuple[DataFrame, str, str]],
) -> list[tuple[int, int, int]]:
    """(rows, bytes, ids with several names) of every (dimension, id, name), in one Spark job."""

    def size(index: int, dimension: DataFrame, id_column: str, name_column: str) -> DataFrame:
        width = F.coalesce(F.octet_length(F.col(id_column).cast("string")), F.lit(0)) + F.coalesce(
            F.octet_length(F.col(name_column).cast("string")), F.lit(0)
        )
        named = F.count(name_column)
        differs = (F.min(name_column) < F.max(name_column)) | ((named > 0) & (named < F.count("*")))
        by_id = dimension.groupBy(id_column).agg(
            F.count("*").alias("n"),
            F.sum(width).alias("bytes"),
            F.coalesce(differs, F.lit(False)).cast("int").alias("differs"),
        )
        return by_id.agg(
            F.lit(index).alias("dimension"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("n_bytes"),
            F.coalesce(F.sum("differs"), F.lit(0)).alias("n_conflicts"),
        )

    sizes = reduce(DataFrame.union, [size(i, *d) for i, d in enumerate(dimensions)])
    return [(r.n_rows, r.n_bytes, r.n_conflicts) for r in sorted(sizes.collect(), key=lambda r: r.dimension)]


def lookup_buckets(
    dimension: DataFrame, id_column: str, name_column: str, buckets: int
) -> DataFrame:
    """(bucket, entries) for every hash bucket, the empty ones included.

    ``entries`` holds (key, value) structs of a few ids if ``buckets`` is chosen to match the
    size of the dimension. The rows are spread over the cluster.
    """
    entries = dimension.where(F.col(id_column).isNotNull()).select(
        bucket_of(F.col(id_column), buckets).alias("bucket"),
        F.struct(F.col(id_column).alias("key"), F.col(name_column).alias("value")).alias("entry"),
    )
    every_bucket = dimension.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("bucket")
    )
    return (
        entries.unionByName(every_bucket, allowMissingColumns=True)
        .groupBy("bucket")
        .agg(F.collect_set("entry").alias("entries"))
    )


def lookup_table(
    dimension: DataFrame, id_column: str, name_column: str, buckets: int
) -> DataFrame:
    """One row with one column ``lookup``: an array of small id → name maps, one per hash bucket.

    A Spark map is searched from its first entry to its last; the bucket number takes a lookup
    straight to a map of a few entries. The whole dimension ends up in one value: this is for
    dimensions that were measured (:func:`dimension_sizes`) and found small.
    """
    return lookup_buckets(dimension, id_column, name_column, buckets).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("bucket", "entries"))),
            lambda b: F.map_from_entries(b.getField("entries")),
        ).alias("lookup")
    )


def buckets_for(rows: int) -> int:
    """A number of buckets that leaves about two entries in each."""
    return min(max(1, rows // 2), 1 << 30)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def find_in_table(table: Column, key: Column, buckets: int) -> Column:
    """The name of ``key`` in a :func:`lookup_table`; a missing or null key gives null."""
    return F.element_at(F.get(table, bucket_of(key, buckets)), key)
