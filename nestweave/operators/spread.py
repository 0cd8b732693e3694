"""Joins on keys that may be hot: one key may hold a third of all rows.

A key is hot when it holds more than ``1 / share`` of all rows. However the data look, at most
``share`` keys can be hot, and cutting each into pieces of that size makes fewer than ``2 * share``
pieces in total. The list of hot keys is therefore bounded by construction, and so is the number
of rows that are repeated on the other side of the join. Every row takes part: hot keys are cut
into pieces, nothing is dropped.

Keys are counted by a hash, so the pass over them moves little. Two keys with the same hash are
cut up together, which changes where their rows go and not what they join to.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.functions.nested import column

PIECE = "_piece"
_HOT = "_hot_hash"
_PIECES = "_pieces"
_TAG_BITS = 6

# Buckets of hashes that are counted before keys are; those above a piece are fewer than share.
BUCKETS = 1 << 20

# Pieces over which rows with a null key are spread; they match nothing.
_NULL_PIECES = 1 << 16


@dataclass(frozen=True)
class HotKeys:
    """When a key counts as hot: above ``floor`` rows and above ``1 / share`` of all rows.

    The same number of rows is the size of the pieces it is cut into.
    """

    floor: int = 100_000
    share: int = 100_000

    def find(
        self, rows: DataFrame, single: Sequence[str] = (), arrays: Sequence[str] = ()
    ) -> dict[str, DataFrame | None]:
        """Per key column its hot values as a table to broadcast, or None without any.

        ``single`` names columns that hold one key per row, ``arrays`` columns that hold an array
        of distinct keys. All are counted together: one pass for the total and, unless it is
        small, one that counts buckets of hashes and, if any is full, one over the keys in those. At most ``share`` hot values in all reach
        the driver.
        """
        names = [*single, *arrays]
        if len(names) > 1 << _TAG_BITS:
            raise ValueError("too many key columns to count together")
        total = F.lit(len(single)).cast("long")
        for name in arrays:
            total = total + F.coalesce(F.array_size(name), F.lit(0))
        n_rows, n_keys = rows.agg(F.count("*"), F.sum(total)).first()
        if n_rows <= self.floor:
            return dict.fromkeys(names)
        hashes = [F.array(*[_tagged(F.col(name), names.index(name)) for name in single])]
        hashes += [_all_tagged(name, names.index(name)) for name in arrays]
        piece_rows = max(self.floor, n_keys // self.share)
        every = rows.select(F.explode(F.concat(*hashes)).alias("hash"))
        # No key is hot in a bucket that isn't. A map task has at most BUCKETS counts, so this
        # moves little also where keys are nearly unique, and most inputs end here.
        bucket = F.pmod("hash", F.lit(BUCKETS)).alias("bucket")
        full = every.groupBy(bucket).agg(F.count("*").alias("n")).where(F.col("n") > piece_rows)
        buckets = [(r.bucket,) for r in full.collect()]
        if not buckets:
            return dict.fromkeys(names)
        few = F.broadcast(rows.sparkSession.createDataFrame(buckets, "bucket long"))
        hot = (
            every.withColumn("bucket", bucket)
            .join(few, "bucket", "left_semi")
            .groupBy("hash")
            .agg(F.count("*").alias("n"))
            .where(F.col("n") > piece_rows)
            .select("hash", F.ceil(F.col("n") / piece_rows).cast("int").alias("pieces"))
            .collect()
        )
        by_tag: dict[int, list[tuple[int, int]]] = {}
        for tagged, pieces in hot:
            tag = tagged % (1 << _TAG_BITS)
            by_tag.setdefault(tag, []).append((tagged - tag, pieces))
        return {
            name: hot_table(rows.sparkSession, by_tag.get(tag, ()))
            for tag, name in enumerate(names)
        }


def _hash(key: Column | str) -> Column:
    """A hash of ``key`` whose lowest bits are free for the number of the column it is from."""
    return F.shiftleft(F.xxhash64(key), _TAG_BITS)


def _tagged(key: Column, tag: int) -> Column:
    return _hash(key).bitwiseOR(F.lit(tag).cast("long"))


def _all_tagged(name: str, tag: int) -> Column:
    hashes = F.transform(name, lambda key: _tagged(key, tag))
    return F.coalesce(hashes, F.array().cast("array<bigint>"))


def hot_table(spark: SparkSession, hot: Iterable[tuple[int, int]]) -> DataFrame | None:
    """(hash, pieces) as a table to broadcast, or None if no key is hot."""
    rows = [(int(key), int(pieces)) for key, pieces in hot]
    if not rows:
        return None
    return F.broadcast(spark.createDataFrame(rows, f"{_HOT} long, {_PIECES} int"))


def assign_piece(
    df: DataFrame, hot: DataFrame | None, key: str, salt: Column, piece: str = PIECE
) -> DataFrame:
    """Gives every row one piece of its key: 0, or ``salt`` modulo the pieces of a hot key."""
    if hot is None:
        return df
    pieces = F.coalesce(F.col(_PIECES), F.lit(1))
    number = F.when(F.col(key).isNull(), F.pmod(salt, F.lit(_NULL_PIECES))).otherwise(
        F.pmod(salt, pieces)
    )
    return (
        df.join(hot, _hash(key) == F.col(_HOT), "left")
        .withColumn(piece, number.cast("int"))
        .drop(_HOT, _PIECES)
    )


def copy_to_pieces(
    df: DataFrame, hot: DataFrame | None, key: str, piece: str = PIECE
) -> DataFrame:
    """Repeats every row once per piece of its key."""
    if hot is None:
        return df
    last = F.coalesce(F.col(_PIECES), F.lit(1)) - 1
    return (
        df.join(hot, _hash(key) == F.col(_HOT), "left")
        .withColumn(piece, F.explode(F.sequence(F.lit(0), last)))
        .drop(_HOT, _PIECES)
    )


def row_salt(rows: DataFrame) -> Column:
    """A salt that a retried task computes again exactly, whatever order its rows come in.

    A hash of the row spreads rows that differ, over as many pieces as there are; the number of the
    input partition spreads copies of one row, which are then cut no finer than the input is. Maps
    can't be hashed and are left out.
    """
    fields = [f for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.spark_partition_id() + F.xxhash64(*[column(f.name) for f in fields])


def join_pieces(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: DataFrame | None,
    salt: Column,
) -> DataFrame:
    """Joins ``left`` to ``right``, which has one row per key, with the keys of ``hot`` cut up."""
    keys = [key] if hot is None else [key, PIECE]
    pieces = copy_to_pieces(right, hot, key)
    return assign_piece(left, hot, key, salt).join(pieces, keys, how).drop(PIECE)


def spread_joins(
    left: DataFrame,
    rights: Mapping[str, DataFrame],
    how: str,
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """Joins ``left`` to one table after the other, each on a key column of ``left``.

    Every table has one row per key. The hot keys of all columns are found first, together. ``how``
    is ``inner``, ``left`` or ``left_semi``. ``hot_keys=None`` is for keys known to be even.
    """
    hot = hot_keys.find(left, single=list(rights)) if hot_keys else dict.fromkeys(rights)
    for key, right in rights.items():
        left = join_pieces(left, right, key, how, hot[key], row_salt(left))
    return left


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """:func:`spread_joins` with one table."""
    return spread_joins(left, {key: right}, how, hot_keys)
