"""Substring dedup (2): relative Lempel-Ziv parsing against every indexed block of smaller documents.

The reference of a document is every document with a smaller id. It is indexed in blocks: of the
four-word sequences in each window of 13 words the one with the smallest hash is the window's
*anchor*, and the windows of one document with the same anchor are a block. Equal windows have
equal anchors, so blocks meet by a shuffle on the anchor, about one row per five words, with a
short hash per window. Sorted by anchor and document, one pass finds for every window the first
document that has it, and joins windows in a row that match the same document in a row to factors.
The parse of a document is greedy: factors that go on from block to block in the same reference are
one, a factor ends where the reference does, and the windows that lie across a boundary are in the
index like any other, so what repeats across a boundary is found too.

Whole copies of a document are found first by the digest of their words and never enter the index;
anchors that hold a share of all blocks are split over several tasks. Windows are compared by their
anchor and 64 bits of another hash, so that chance matches stay out of reach under any anchor.

Defined results: a null or empty text has no words; very long texts are cut into segments that overlap; a document is
no reference for itself; rows that repeat a ``doc_id`` count as one document's rows, told apart by a hash of
their texts and each judged alone against smaller ids; a row without ``doc_id`` is neither judged nor a
reference; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import attach, each_row, small, text_hash, texts, written

WINDOW = 13
ANCHOR = 4
#: Windows hashed at a time, which bounds the memory that a very long text takes.
SEGMENT = 1 << 16
#: Anchors that are split, at most: those with the most blocks.
HOT_BLOCKS = 2000
#: One in so many documents is looked at to find the anchors to split; all of them are joined.
HOT_SAMPLE = 16
#: From so many blocks of the sampled documents on, an anchor is split.
HOT_COUNT = 200
#: Blocks of hot anchors for which there is one more list of the places of each: no list is much longer.
REPEATS = 10_000

_MASK = (1 << 64) - 1
#: Odd multipliers of the two hashes; any odd numbers with mixed bits will do.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class TextHashes:
    """Hashes of word sequences by differences of sums over all bytes of a text."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20240229)
        self.bytes = [rng.integers(1, _MASK, 256, dtype=np.uint64) for _ in _BASES]
        self.powers = [np.ones(1, dtype=np.uint64) for _ in _BASES]
        self.inverses = [np.ones(1, dtype=np.uint64) for _ in _BASES]

    def _grow(self, n: int) -> None:
        while len(self.powers[0]) < n:
            for table, bases in ((self.powers, _BASES), (self.inverses, [pow(b, -1, 1 << 64) for b in _BASES])):
                for i, base in enumerate(bases):
                    step = np.uint64(pow(base, len(table[i]), 1 << 64))
                    table[i] = np.concatenate([table[i], table[i] * step])

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.bytes[which][data] * self.powers[which][: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.inverses[which][start])


def blocks_of(words: list[bytes], hashes: TextHashes) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, start, windows) arrays of the blocks of one document, in segments.

    ``start`` is the first window of the block, ``windows`` the 64-bit hashes of its windows, one
    ``bytes`` per block.
    """
    for at in range(0, len(words) - WINDOW + 1, SEGMENT):
        part = words[at : at + SEGMENT + WINDOW - 1]
        data = b" ".join(part)
        raw = np.frombuffer(data, dtype=np.uint8)
        spaces = np.flatnonzero(raw == 32)
        start = np.concatenate([[0], spaces + 1])
        end = np.concatenate([spaces, [len(raw)]])
        first, second = hashes.sums(raw, 0), hashes.sums(raw, 1)
        grams = hashes.between(first, 0, start[: len(start) - ANCHOR + 1], end[ANCHOR - 1 :])
        windows = hashes.between(second, 1, start[: len(start) - WINDOW + 1], end[WINDOW - 1 :])
        choice = sliding_window_view(grams, WINDOW - ANCHOR + 1).argmin(1) + np.arange(len(windows))
        begin = np.concatenate([[0], np.flatnonzero(np.diff(choice)) + 1])
        raw = windows.astype("<u8").tobytes()
        stop = np.concatenate([begin[1:], [len(windows)]])
        cut = [raw[8 * a : 8 * b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
        yield grams[choice[begin]].view(np.int64), begin + at, cut


_BLOCK = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("variant", pa.int64()), ("start", pa.int32()), ("windows", pa.binary())])

_HOT_BLOCK = _BLOCK.insert(4, pa.field("times", pa.int32()))


def blocks(rows: DataFrame) -> DataFrame:
    """The blocks of every text of ``rows`` (doc_id, variant, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TextHashes()
        for batch in batches:
            for doc_id, variant, text in each_row(batch):
                for anchor, start, windows in blocks_of(text.encode().split(), hashes):
                    names = [pa.array(np.full(len(anchor), x, dtype=np.int64)) for x in (doc_id, variant)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), *names, pa.array(start, pa.int32()), pa.array(windows, pa.binary())], schema=_BLOCK
                    )

    return rows.select("doc_id", "variant", "text").mapInArrow(_batched(cut), "anchor long, doc_id long, variant long, start int, windows binary")


def hot_blocks(rows: DataFrame, hot: list[int]) -> DataFrame:
    """The blocks of ``rows`` under the anchors ``hot``; a block ``times`` in a row, each right after the other, is one row.

    A few words over and over are one block over and over; rows don't grow with that.
    """
    chosen = np.sort(np.array(hot, dtype=np.int64))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TextHashes()
        for batch in batches:
            for doc_id, variant, text in each_row(batch):
                for anchor, start, windows in blocks_of(text.encode().split(), hashes):
                    near = chosen[np.minimum(np.searchsorted(chosen, anchor), len(chosen) - 1)]
                    runs: list[list] = []
                    for i in np.flatnonzero(near == anchor).tolist():
                        last = runs[-1] if runs else None
                        # Blocks with equal windows have one anchor.
                        if last and last[0] == i - last[1] and windows[i] == windows[last[0]]:
                            last[1] += 1
                        else:
                            runs.append([i, 1])
                    if runs:
                        at = [i for i, _ in runs]
                        names = [pa.array(np.full(len(at), x, dtype=np.int64)) for x in (doc_id, variant)]
                        times = pa.array([n for _, n in runs], pa.int32())
                        places = [pa.array(start[at], pa.int32()), times, pa.array([windows[i] for i in at], pa.binary())]
                        yield pa.RecordBatch.from_arrays([pa.array(anchor[at]), *names, *places], schema=_HOT_BLOCK)

    schema = "anchor long, doc_id long, variant long, start int, times int, windows binary"
    return rows.select("doc_id", "variant", "text").mapInArrow(_batched(cut), schema)


def _batched(function, rows: int = 20_000):
    """``function`` with its small batches put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in function(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


_MATCH = "doc_id long, variant long, start int, n int, ref_doc long, ref_start int"
_MATCHES = pa.schema([
    ("doc_id", pa.int64()), ("variant", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())
])


class _Windows:
    """The windows of a run of blocks as flat arrays, one entry per window."""

    def __init__(self, anchor, doc, variant, start, window):
        self.columns = [anchor, doc, variant, start, window]
        self.anchor, self.doc, self.variant, self.start, self.window = self.columns

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Windows:
        data = batch.column("windows")
        ends = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset : data.offset + len(data) + 1]
        # The bytes of a filtered or sliced batch need not begin at a multiple of eight.
        window = np.frombuffer(data.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view("<u8")
        n = np.diff(ends) // 8
        nth = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(batch.column("start").to_numpy(), n) + nth
        one = [np.repeat(batch.column(c).to_numpy(), n) for c in ("anchor", "doc_id", "variant")]
        return cls(*one, start, window)

    def take(self, which) -> _Windows:
        return _Windows(*(c[which] for c in self.columns))

    def then(self, other: _Windows) -> _Windows:
        return _Windows(*(np.concatenate(x) for x in zip(self.columns, other.columns, strict=True)))


def _firsts(w: _Windows) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal windows together, first document first; where each class begins."""
    # The rows come in the order of their documents and places, which a stable sort keeps.
    order = np.argsort(_mixed(w.anchor.view(np.uint64) + w.window), kind="stable")
    s = w.take(order)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (s.anchor[1:] != s.anchor[:-1]) | (s.window[1:] != s.window[:-1])
    return order, new


def _factors(doc, variant, start, ref_doc, ref_start) -> pa.RecordBatch:
    """Matched windows joined to runs: the next window that matches the next place of the same document."""
    order = np.lexsort((start, variant, doc))
    doc, variant, start, ref_doc, ref_start = (x[order] for x in (doc, variant, start, ref_doc, ref_start))
    new = np.ones(len(doc), dtype=bool)
    same = (doc[1:] == doc[:-1]) & (variant[1:] == variant[:-1]) & (ref_doc[1:] == ref_doc[:-1])
    new[1:] = ~(same & (start[1:] == start[:-1] + 1) & (ref_start[1:] == ref_start[:-1] + 1))
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(doc)))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[at]), pa.array(variant[at]), pa.array(start[at], pa.int32()), pa.array(n, pa.int32()), pa.array(ref_doc[at]), pa.array(ref_start[at], pa.int32())], schema=_MATCHES
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of blocks that come sorted by anchor and document.

    Of the last anchor of a batch, the first place of every different window is carried on to the
    next batch; nothing else is held.
    """
    carried: _Windows | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        # Most anchors stand alone; only those that don't, and the last one, are unfolded.
        anchor = batch.column("anchor").to_numpy()
        again = anchor[1:] == anchor[:-1]
        wanted = np.append(again, True) | np.append(False, again)
        wanted |= anchor == anchor[-1]
        if carried is not None:
            wanted |= anchor == carried.anchor[0]
        w = _Windows.of(batch.filter(pa.array(wanted)))
        if carried is not None:
            w = carried.then(w)
        order, new = _firsts(w)
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]  # of every window, the first of its class
        hit = w.doc[order] > w.doc[head]
        last = new & (w.anchor[order] == w.anchor[-1])
        held = 0 if carried is None else len(carried.doc)
        hit &= order >= held  # carried windows were judged before
        if hit.any():
            a, b = order[hit], head[hit]
            yield _factors(w.doc[a], w.variant[a], w.start[a], w.doc[b], w.start[b])
        carried = w.take(order[last])


def _hot_anchors(rows: DataFrame) -> list[int]:
    """Anchors that may hold many blocks, fewer than HOT_BLOCKS; they only decide how blocks are dealt out."""
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    counts = blocks(some).groupBy("anchor").count().where(F.col("count") > HOT_COUNT)
    top = counts.orderBy(F.desc("count"), "anchor").limit(HOT_BLOCKS).collect()
    return [r.anchor for r in top]


def matches(rows: DataFrame) -> DataFrame:
    """Runs of windows of ``rows`` (doc_id, variant, text) that also start in a smaller document."""
    hot = _hot_anchors(rows)
    parts = blocks(rows)
    session = rows.sparkSession
    few = F.broadcast(session.createDataFrame([(a,) for a in hot], "anchor long"))
    cold = parts.join(few, "anchor", "left_anti") if hot else parts
    found = cold.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start").mapInArrow(_scan, _MATCH)
    if not hot:
        return found

    # Equal blocks of hot anchors combine on the map side. A later one matches the first as a whole,
    # and only the windows of first blocks, and of their repeats in the same document, are compared
    # one by one, again with their first place. The first is where its document has most of them in a row.
    block = ["anchor", "windows"]
    dense = written(hot_blocks(rows, hot).withColumn("fewer", F.negative("times")), "hot-blocks")
    place = F.struct("doc_id", "variant", "fewer", "start", "times")
    places = dense.groupBy(*block).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    places = written(places, "hot-places")
    # The places of a block meet its first as lists, which combine on the map side and don't grow with the block.
    piece = F.pmod(F.xxhash64("doc_id", "variant", "start"), F.lit(1 + dense.count() // REPEATS)).alias("piece")
    lists = dense.groupBy(*block, piece).agg(F.collect_list(place).alias("places"))
    again = lists.join(places.where("n > 1"), block).repartition(*block, "piece")
    again = again.select(*block, "first", F.explode("places").alias("place")).where("place > first")
    # The document of a first block may hold it again. Its first is no smaller document, so those blocks are
    # unfolded as well; of the others only the place is needed.
    again = again.select(
        "anchor", "place.*", "first", (F.octet_length("windows") / 8).cast("int").alias("n"),
        F.when(F.col("place.doc_id") == F.col("first.doc_id"), F.col("windows")).alias("windows"),
    )
    again = written(again, "hot-repeats")
    # As many in a row as the first has are one match; it ends where the reference does.
    whole = again.where("windows IS NULL").withColumn("nth", F.explode(F.expr("sequence(0, times - 1, first.times)")))
    n = F.col("n") * F.least(F.col("times") - F.col("nth"), F.col("first.times"))
    whole = whole.select("doc_id", "variant", (F.col("start") + F.col("nth") * F.col("n")).alias("start"), n.alias("n"), *_first())
    single = places.select("anchor", "first.doc_id", "first.variant", "first.start", "first.times", "windows")
    single = single.unionByName(again.where("windows IS NOT NULL").select("anchor", "doc_id", "variant", "start", "times", "windows"))
    wide = written(single.mapInArrow(_flat, "anchor long, window long, doc_id long, variant long, start int, step int, times int"), "hot-windows")
    place = F.struct("doc_id", "variant", "start")
    firsts = wide.groupBy("anchor", "window").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    hits = wide.join(firsts.where("n > 1").drop("n"), ["anchor", "window"]).where("doc_id > first.doc_id")
    every = F.explode(F.expr("sequence(start, start + (times - 1) * step, step)")).alias("start")
    one = hits.select("doc_id", "variant", every, F.lit(1).alias("n"), *_first())
    return found.unionByName(whole).unionByName(one)


def _first() -> list[Column]:
    return [F.col("first.doc_id").alias("ref_doc"), F.col("first.start").alias("ref_start")]


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of every block, named by its hash; there are ``times`` of it, ``step`` windows apart."""
    for batch in batches:
        w = _Windows.of(batch)
        step = pc.binary_length(batch.column("windows")).to_numpy() // 8
        step, times = np.repeat(step, step), np.repeat(batch.column("times").to_numpy(), step)
        columns = [pa.array(w.anchor), pa.array(w.window.view(np.int64)), pa.array(w.doc), pa.array(w.variant), pa.array(w.start.astype(np.int32))]
        names = ["anchor", "window", "doc_id", "variant", "start", "step", "times"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(step, pa.int32()), pa.array(times, pa.int32())], names=names)


def parse(docs: DataFrame) -> DataFrame:
    """(doc_id, variant, start, n_words, ref_doc, ref_start): the factors of every document, greedily joined.

    ``docs`` (doc_id, text) may have a ``variant`` that tells rows of one id apart. ``n_words`` words from word ``start`` equal those of ``ref_doc`` from ``ref_start``. Whole copies
    must have been taken out (:func:`remove_repeats` does).
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] | None = None
        for batch in batches:
            rows = []
            for doc, variant, start, n, ref_doc, ref_start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = held and held[:2] == [doc, variant] and held[4] == ref_doc
                if same and held[2] + held[3] == start and held[5] + held[3] == ref_start:
                    held[3] += n
                else:
                    if held:
                        rows.append(held)
                    held = [doc, variant, start, n, ref_doc, ref_start]
            if rows:
                yield _table(rows)
        if held:
            yield _table([held])

    def _table(rows: list[list[int]]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MATCHES.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_MATCHES)

    rows = docs if "variant" in docs.columns else docs.withColumn("variant", F.lit(0).cast("long"))
    runs = matches(rows).repartition("doc_id").sortWithinPartitions("doc_id", "variant", "start")
    return runs.mapInArrow(join, _MATCH).select(
        "doc_id", "variant", "start", (F.col("n") + WINDOW - 1).alias("n_words"), "ref_doc", "ref_start"
    )


def _outline(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, digest) of every row, the digest that of its words joined by a space."""

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for _, _, text in each_row(batch):
                found = text.encode().split()
                sizes.append(len(found))
                digests.append(hashlib.sha256(b" ".join(found)).digest())
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_words", "digest"])

    return docs.mapInArrow(outline, "doc_id long, text_hash long, n_words long, digest binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    A word goes if a factor covers it. ``kept_sha256`` is of the words that stay, one space between.
    """
    rows = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    outline = written(_outline(rows), "outlines")
    groups = outline.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    copies = attach(outline, written(groups, "outline-groups"), "digest", "n").drop("n")
    copy = F.coalesce((F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= WINDOW), F.lit(False))
    copies = written(copies.withColumn("copy", copy), "copies")
    later = copies.where("copy").select("doc_id", "text_hash")
    # Whole copies need no parse. Few or many, their names decide only which rows are parsed.
    single = rows.where("doc_id IS NOT NULL").join(small(later.distinct(), 16), ["doc_id", "text_hash"], "left_anti")
    # Few ids stand for several texts; only those need a name beside the id.
    several = copies.where("NOT copy").groupBy("doc_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b"))
    several = written(several.where("a < b").select("doc_id", F.lit(True).alias("several")), "repeated-ids")

    def with_variant(frame: DataFrame) -> DataFrame:
        variant = F.when(F.col("several"), F.col("text_hash")).otherwise(0).cast("long")
        return frame.join(small(several, 8), "doc_id", "left").withColumn("variant", variant).drop("several")

    single = with_variant(single)
    row = ["doc_id", "variant"]
    factors = written(
        parse(single).groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("start", "n_words"))).alias("factors")),
        "factors",
    )
    side = factors.hint("merge")  # factors grow with the texts, so they meet by a shuffle at every size

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in each_row(batch):
                every = text.encode().split()
                kept, at = [], 0
                for f in found:
                    kept += every[at : max(at, f["start"])]
                    at = max(at, f["start"] + f["n_words"])
                kept += every[at:]
                out.append((doc_id, len(every), len(every) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    cut = single.join(side, row).select("doc_id", "text", "factors").mapInArrow(keep, schema)
    nothing = hashlib.sha256(b"").hexdigest()
    whole = F.col("n_words").alias("n_removed"), F.lit(nothing).alias("kept_sha256")
    gone = copies.where("copy").select("doc_id", "n_words", *whole)
    kept = with_variant(copies.where("NOT copy")).join(factors.select(*row), row, "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lower(F.hex("digest")).alias("kept_sha256")
    )
    return cut.unionByName(gone).unionByName(kept)
