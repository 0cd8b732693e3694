"""SimHash near-dedup (10): Golay-code fuzzy hashing of 64-bit fingerprints.

A fingerprint is cut into three segments of 22, 21 and 21 bits. Of at most two differing bits, one
segment has none and the next has at most two; so a key is one segment as it is together with a
Golay code word near the next (:mod:`nestweave.llm.golay`). Every fingerprint has 3 to 18 keys, and
two that link share at least one. Keys join, and the differing bits are counted in the join.

Copies collapse first: the join sees every fingerprint once. A key with more than ``MOST`` different
fingerprints (a dense cluster) is left to an exact way that makes no pairs: every fingerprint of
the cluster is filed under itself and its 64 neighbours at one bit, two that differ in two bits or
fewer meet under one of those, at most 65 meet there, and all that meet are linked to the smallest.

Defined results: a null or empty text has fingerprint zero, linked like any other; rows that
repeat a ``doc_id`` are fingerprinted one by one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.llm.common import attach, components, texts, written
from nestweave.llm.golay import codeword_indices

SHINGLE = 3
SEED = 42
DISTANCE = 2
#: Widths of the segments, from the lowest bit.
SEGMENTS = (22, 21, 21)
#: Different fingerprints under one key up to which pairs are compared; above, see the module.
MOST = 64
#: Words hashed at a time, which bounds the memory that a very long text takes.
BLOCK = 1 << 18


def fingerprint_of(text: str) -> int:
    """The fingerprint of one text as an unsigned number."""
    found = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    ones, total = np.zeros(64, dtype=np.int64), 0
    if 0 < len(found) < SHINGLE:
        found = [b" ".join(found)]
        width = 1
    else:
        width = SHINGLE
    for at in range(0, len(found) - width + 1, BLOCK):
        part = found[at : at + BLOCK + width - 1]
        shingles = zip(*(part[i:] for i in range(width)), strict=False)
        hashes = [xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in shingles]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint as a signed long."""
    rows = texts(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint_of(x.as_py()) for x in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    named = T.StructField("doc_id", rows.schema["doc_id"].dataType)
    return rows.mapInArrow(cut, T.StructType([named, T.StructField("fp", T.LongType())]))


def keys_of(values: np.ndarray) -> list[np.ndarray]:
    """The keys of every signed fingerprint."""
    bits = values.view(np.uint64)
    parts, at = [], 0
    for width in SEGMENTS:
        part = bits >> np.uint64(at) & np.uint64((1 << width) - 1)
        parts.append(part.astype(np.int64))
        at += width
    found = []
    for i, exact in enumerate(parts):
        near = codeword_indices(parts[(i + 1) % len(parts)])
        found.append(np.where(near < 0, -1, (i << 40) | (exact[:, None] << 12) | near))
    every = np.concatenate(found, axis=1)
    return [row[row >= 0] for row in every]


def fuzzy_keys(distinct: DataFrame) -> DataFrame:
    """(fp, key) of every fingerprint of ``distinct`` (column fp)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column("fp").to_numpy()
                lists = keys_of(values)
                columns = [np.repeat(values, [len(x) for x in lists]), np.concatenate(lists)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fp", "key"])

    return distinct.select("fp").mapInArrow(cut, "fp long, key long")


def linked_pairs(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b) pairs of fingerprints that connect all linked ones of ``distinct`` (column fp)."""
    keyed = written(fuzzy_keys(distinct), "keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = written(sizes, "key-sizes")
    narrow = keyed.join(sizes.where(F.col("n") <= most).select("key"), "key")
    left, right = (narrow.select("key", F.col("fp").alias(x)) for x in "ab")
    close = (F.col("a") < F.col("b")) & (
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    )
    pairs = left.join(right, "key").where(close).select("a", "b").distinct()

    dense = keyed.join(sizes.where(F.col("n") > most).select("key"), "key", "left_semi")
    dense = dense.select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(64)])
    near = dense.select(
        "fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x.cast("long")))).alias("at")
    )
    meet = near.groupBy("at").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    star = meet.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return pairs.unionByName(star.where("a <> b").distinct())


def near_duplicates(docs: DataFrame, most: int = MOST) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest ``doc_id`` reachable over links."""
    rows = written(fingerprints(docs), "fingerprints")
    groups = written(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")),
        "fingerprint-groups",
    )
    roots = components(linked_pairs(groups.select("fp"), most), "a", "b")
    joined = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", "n", F.coalesce("root", "fp").alias("root")
    )
    joined = written(joined, "fingerprint-roots")
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("m"))
    found = attach(joined.drop("first_id"), smallest, "root", "m").select("fp", "n", "component_id")
    return attach(rows, written(found, "fingerprint-components"), "fp", "n").select(
        "doc_id", "fp", "component_id"
    )
