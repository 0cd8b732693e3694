"""Near copies by five-word shingles: MinHash finds the candidates, their exact Jaccard decides.

Texts with the same set of shingles are one *class*, and one row of each class is compared. A class's smallest
hash under each of ``BANDS * ROWS`` functions goes into a band of ``ROWS``. Classes with a band in common
are candidates; two with a Jaccard of 0.8 have none in common with a probability of 1.2e-7. Shingles
are compared by 64 bits of their hash.

A band that many classes share makes no pairs of them all. A shingle that only one candidate has matches
nothing: with ``u`` of them among its ``n``, a class shares ``n - u`` at most. That leaves out whoever can link to
nothing. The shingles that others have too are counted by ``PARTS`` ranges of their hashes, up to four in
a row of four *marks*: what two classes share is no more than their common marks and the lesser of what they
have beyond. Two can't link where that is below 0.8 / 1.8 of both their shingles; the bound is exact and costs
a few words a class. Then every class is compared with the *centre* of each of its bands, the class with the smallest share of
shingles of its own, which joins altered copies to what they were made from; again so among those of a band
that aren't joined to its centre; and only classes that are still in different groups, and that the bound
lets link, make pairs.

Defined results: words are split by ASCII white space and only A-Z are lowered; a text of fewer
than five words is one shingle, a null or empty one too; very long texts are hashed in blocks; a row without ``doc_id``
is not compared; rows that repeat a ``doc_id`` are told apart by their texts, equal rows are one; links are closed
over chains; of a group the row with the smallest (doc_id, text_hash) stays; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import attach, components, each_row, small, text_hash, texts, written

SHINGLE = 5
#: The least Jaccard of a link in hundredths.
THRESHOLD = 80
BANDS, ROWS = 40, 5
#: Times that classes are compared with the centres of their bands before pairs are made.
ROUNDS = 2
#: Ranges of hashes in which shared shingles are counted, and marks of each: 16 words in all.
PARTS, MARKS = 256, 4
#: Pairs of one class that are compared in one task, about.
PIECE = 1000
#: Hashes that are handed on at a time, about.
AT_ONCE = 1 << 17
#: Shingles hashed at a time, which bounds the memory that a very long text takes.
BLOCK = 512


def shingles(text: str) -> Iterator[bytes]:
    found = text.encode().lower().split()
    width = min(SHINGLE, len(found))
    return (b" ".join(found[i : i + width]) for i in range(len(found) - width + 1))


def hashes_of(text: str) -> np.ndarray:
    """The hashes of the shingles of a text, each once, in ascending order."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x) for x in shingles(text)), dtype=np.uint64))


def _set_name(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def bands_of(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The band keys of one set of shingles as signed numbers."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        least = np.minimum(least, ((part ^ (part >> np.uint64(29)))[:, None] * factors).min(0))
    keys = [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64)


def outlines(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, set, bands): the name of the set of shingles and the bands of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = np.random.default_rng(20240511).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            names, bands = [], []
            for _, _, text in each_row(batch):
                hashes = hashes_of(text)
                names.append(_set_name(hashes))
                bands.append(bands_of(hashes, factors))
            if names:
                lists = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(bands)), BANDS).cast(pa.list_(pa.int64()))
                columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(names, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "set", "bands"])

    return rows.mapInArrow(cut, "doc_id long, text_hash long, set binary, bands array<long>")


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """(set, hashes) of every row of ``rows`` (doc_id, text_hash, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, lists, size = [], [], 0
            for _, _, text in each_row(batch):
                hashes = hashes_of(text)
                names.append(_set_name(hashes))
                lists.append(hashes.view(np.int64))
                size += len(hashes)
                if size >= AT_ONCE:
                    yield table(names, lists)
                    names, lists, size = [], [], 0
            if names:
                yield table(names, lists)

    def table(names: list[bytes], lists: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(names, pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["set", "hashes"])

    return rows.mapInArrow(cut, "set binary, hashes array<long>")


def _profiles(sets: DataFrame) -> DataFrame:
    """(node, n, u, marks, beyond) of ``sets`` (node, n, u, others); what can link to nothing is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, beyond = [], []
            for others in batch.column("others"):
                hashes = others.values.to_numpy().view(np.uint64)
                counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=PARTS)
                some = np.minimum(counts, MARKS)
                unary = ((1 << some) - 1).astype(np.uint64).reshape(-1, 64 // MARKS)
                marks.append((unary << np.arange(0, 64, MARKS, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64))
                beyond.append(int((counts - some).sum()))
            if marks:
                columns = [*(batch.column(c) for c in ("node", "n", "u")), pa.array(marks, pa.list_(pa.int64())), pa.array(beyond, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "u", "marks", "beyond"])

    able = sets.where((F.col("n") - F.col("u")) * 100 >= F.col("n") * THRESHOLD).select("node", "n", "u", "others")
    return able.mapInArrow(count, "node long, n long, u long, marks array<long>, beyond long")


def _may_link(a: str, b: str) -> Column:
    """What two classes can share at most is enough for a link."""
    common = F.least(F.col(f"beyond_{a}"), F.col(f"beyond_{b}"))
    for i in range(PARTS * MARKS // 64):
        common = common + F.bit_count(F.get(f"marks_{a}", F.lit(i)).bitwiseAND(F.get(f"marks_{b}", F.lit(i))))
    return common * (100 + THRESHOLD) >= (F.col(f"n_{a}") + F.col(f"n_{b}")) * THRESHOLD


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with a Jaccard of at least the threshold; an ``a`` in very many of them is dealt to pieces."""
    many = written(pairs.groupBy("a").agg(F.count("*").alias("m")), "pairs-by-centre")
    pieces = F.floor(F.col("m") / PIECE) + 1
    left = many.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a")), "a")
    left = left.select("a", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"), "hashes_a")
    right = attach(pairs, many, "a", "m").select("a", "b", F.pmod(F.xxhash64("b"), pieces).alias("piece"))
    right = right.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b")), "b")
    both = right.join(left, ["a", "piece"])
    shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
    either = F.size("hashes_a") + F.size("hashes_b") - shared
    return both.where(shared * 100 >= either * THRESHOLD).select("a", "b")


def _links(shared: DataFrame, profiles: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) pairs of nodes that connect all linked ones.

    ``shared`` (key, node) are bands that several classes have, ``profiles`` of those that may link, ``sets``
    (node, hashes) their shingles.
    """
    columns = ["node", "n", "u", "marks", "beyond"]
    best = F.min(F.struct((F.col("u") / F.col("n")).alias("share"), *columns)).alias("best")

    def open_bands(grouped: DataFrame) -> DataFrame:
        """(key, best) of the bands whose classes aren't all in one group, and their centres."""
        ends = F.min("root").alias("x"), F.max("root").alias("y")
        return grouped.groupBy("key").agg(*ends, best).where("x < y").select("key", "best")

    grouped = shared.join(profiles, "node").withColumn("root", F.col("node"))
    links: list[DataFrame] = []
    met: list[DataFrame] = []
    for i in range(ROUNDS):
        grouped = rest = written(grouped, "band-groups")
        if i:  # what isn't in the group of its band's centre, with which it has been compared
            centres = open_bands(grouped).select("key", F.col("best.node").alias("node")).join(grouped, ["key", "node"])
            rest = grouped.join(centres.select("key", F.col("root").alias("centre_root")), "key")
            rest = written(rest.where("root <> centre_root").drop("centre_root"), "band-rests")
        star = rest.join(open_bands(rest), "key").where("best.node <> node")
        star = star.select(
            *[F.col(f"best.{c}").alias(f"{c}_a") for c in columns], *[F.col(c).alias(f"{c}_b") for c in columns]
        )
        star = star.where(_may_link("a", "b")).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
        met.append(written(star, "star-pairs"))
        links.append(written(_alike(met[-1], sets), "star-links"))
        roots = components(reduce(DataFrame.unionByName, links), "a", "b")
        grouped = grouped.drop("root").join(roots, "node", "left").select("key", *columns, F.coalesce("root", "node").alias("root"))
    grouped = written(grouped, "band-groups")
    apart = written(grouped.join(open_bands(grouped).select("key"), "key"), "open-bands")
    one, two = (apart.select("key", *[F.col(c).alias(f"{c}_{x}") for c in (*columns, "root")]) for x in "ab")
    pairs = one.join(two, "key").where((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & _may_link("a", "b"))
    pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    for star in met:
        for a, b in (("a", "b"), ("b", "a")):
            pairs = pairs.join(star.select(F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"], "left_anti")
    links.append(_alike(written(pairs, "apart-pairs"), sets))
    return reduce(DataFrame.unionByName, links)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, component_id, kept, stays) of every row in a group of several; the one that is kept too.

    ``stays`` (doc_id, text_hash) names the one that is kept.
    """
    rows = texts(docs).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    every = written(outlines(rows), "outlines")
    classes = every.groupBy("set").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("size"), F.any_value("bands").alias("bands")
    )
    # Numbered once and written: what is read from here on has the same numbers.
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("node", F.explode("bands").alias("key"))
    several = written(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "several-bands")
    shared = written(keyed.join(small(several, 16), "key"), "shared-bands")
    candidates = classes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "set", "first.doc_id", "first.text_hash")
    candidates = written(candidates, "candidates")
    some = rows.join(candidates.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_semi")
    sets = _shingle_sets(some).join(candidates.select("node", "set"), "set").select("node", "hashes").dropDuplicates(["node"])
    sets = written(sets, "shingle-sets")
    once = sets.select("node", F.explode("hashes").alias("h")).groupBy("h").agg(F.min("node").alias("node"), F.count("*").alias("m")).where("m = 1")
    alone = once.groupBy("node").agg(F.collect_list("h").alias("own"))
    others = F.when(F.col("own").isNull(), F.col("hashes")).otherwise(F.array_except("hashes", "own"))
    u = F.when(F.col("own").isNull(), F.lit(0)).otherwise(F.size("own"))
    sized = sets.join(alone, "node", "left").select("node", F.size("hashes").cast("long").alias("n"), u.cast("long").alias("u"), others.alias("others"))
    profiles = written(_profiles(sized), "profiles")
    roots = components(_links(shared, profiles, sets), "a", "b")
    linked = classes.select("node", "set", "first", "size").join(roots, "node", "left")
    linked = linked.where("size > 1 OR root IS NOT NULL").select("set", "first", "size", F.coalesce("root", "node").alias("root"))
    linked = written(linked, "linked-classes")
    groups = linked.groupBy("root").agg(F.min("first").alias("stays"), F.sum("size").alias("members"), F.count("*").alias("m"))
    groups = written(groups.where("members > 1"), "near-groups")
    found = attach(linked.join(groups.select("root"), "root", "left_semi"), groups, "root", "m").select("set", "stays", "size")
    marked = attach(every.join(found.select("set"), "set", "left_semi").drop("bands"), written(found, "near-sets"), "set", "size")
    first = F.col("stays.text_hash") == F.col("text_hash")
    kept = first & (F.col("doc_id") == F.col("stays.doc_id"))
    return marked.select("doc_id", "text_hash", F.col("stays.doc_id").alias("component_id"), kept.alias("kept"), "stays")
