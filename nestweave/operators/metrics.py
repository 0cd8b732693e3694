"""Counts of an enrichment, as aggregates that ride along with the write.

The same expressions serve ``DataFrame.observe`` (no pass of their own) and ``DataFrame.agg``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.functions.nested import array_total, inner_counts


def metric_columns(shapes: Sequence[tuple[str, str, str]]) -> list[Column]:
    """Documents, and per (array, inner array, names column): inner elements, hits and misses.

    The names column holds one name per outer element, null where nothing was found.
    """
    columns = [F.count(F.lit(1)).alias("documents")]
    for array, inner, names in shapes:
        counts = inner_counts(array, inner)
        hits = F.zip_with(
            counts, F.col(names), lambda n, name: F.when(name.isNotNull(), n).otherwise(0)
        )
        elements, found = F.sum(array_total(counts)), F.sum(array_total(hits))
        zero = F.lit(0).cast("long")
        columns += [
            F.coalesce(elements, zero).alias(f"{array}_elements"),
            F.coalesce(found, zero).alias(f"{array}_hits"),
            F.coalesce(elements - found, zero).alias(f"{array}_misses"),
        ]
    return columns


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows as a one-row DataFrame."""
    return df.agg(F.count("*").alias("n_rows"))


def digest_columns(columns: Sequence[Column]) -> list[Column]:
    """The number of rows and a digest of them as a multiset, for ``agg`` or ``observe``.

    The digest is two sums of 64-bit row hashes of different seeds, modulo 2^64. It doesn't depend on
    the order of the rows or on how they are cut, digests of parts add up (:func:`add_digests`), and a row that
    is lost, doubled or changed shows but for a chance of about 2^-128. ``columns`` must hold no maps.
    """
    sums = []
    for i in range(2):
        # Sums of halves stay far from 38 digits, which Spark would make an error or a null of.
        row = F.xxhash64(F.lit(i), *columns)
        halves = row.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(row, 32)
        low, high = (F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)) for h in halves)
        sums += [low.cast("decimal(38,0)").alias(f"low_{i}"), high.cast("decimal(38,0)").alias(f"high_{i}")]
    return [F.count(F.lit(1)).alias("n_rows"), *sums]


def digest_of(observed: Mapping[str, object]) -> tuple[int, int, int]:
    """(rows, digest, digest) of what :func:`digest_columns` gave."""
    sums = [(int(observed[f"low_{i}"]) + (int(observed[f"high_{i}"]) << 32)) % (1 << 64) for i in range(2)]
    return int(observed["n_rows"]), sums[0], sums[1]


def add_digests(digests: Iterable[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The digest of all rows of several parts."""
    total = (0, 0, 0)
    for part in digests:
        total = (total[0] + part[0], *((a + b) % (1 << 64) for a, b in zip(total[1:], part[1:], strict=True)))
    return total
