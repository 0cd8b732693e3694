"""Best-fit packing (4): Martello-Toth dominance reduction, then best fit for the remainder.

Documents are tokenised and cut into pieces on the executors. Lengths are whole numbers up to the
capacity, so the *instance* of the packing problem is a histogram of at most ``capacity`` numbers,
however many pieces there are: only that reaches the driver. There the reduction fixes sequences
that some optimal packing contains, many alike at a time, and best fit decreasing fills the rest.
The result is a list of slots, each for a range of ranks within a length; the pieces learn their
ranks on the executors (counted in buckets, so no length is sorted in one task) and look up their
slots.

Defined results: a null or empty text is the end id alone; a very long one is cut into pieces; rows that repeat a
``doc_id`` are packed like any other; pieces of one length are ranked by doc_id, piece and checksum, and those
equal in all three change places without a difference; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import each_row, texts, written
from nestweave.llm.tokens import text_ids

log = logging.getLogger(__name__)

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that are ranked in one task, about.
BUCKET_ROWS = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document; only documents above ``capacity`` are cut."""

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, step = text_ids(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, text in each_row(batch):
                data = ids.text(text) + end
                for i, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    rows = texts(docs).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(cut, PIECES)


class Histogram:
    """Counts by length, with the largest and smallest lengths that are left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.none = capacity + 1  # stands for a piece that isn't there: it fits nowhere
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.lengths = sorted(self.left)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def largest_to(self, room: int, below: dict[int, int]) -> int | None:
        """The largest length up to ``room`` of which more is left than ``below`` sets aside."""
        i = bisect_left(self.lengths, room + 1) - 1
        while i >= 0 and self.left[self.lengths[i]] <= below.get(self.lengths[i], 0):
            i -= 1
        return self.lengths[i] if i >= 0 else None

    def smallest(self, n: int, below: dict[int, int], above: int = 0) -> list[int]:
        """The ``n`` smallest over ``above`` besides what ``below`` sets aside; ``none`` where there are fewer."""
        found: list[int] = []
        for length in islice(self.lengths, bisect_left(self.lengths, above + 1), None):
            found += [length] * min(n - len(found), self.left[length] - below.get(length, 0))
            if len(found) == n:
                break
        return found + [self.none] * (n - len(found))


Pattern = tuple[tuple[int, int], ...]  # (length, how many), in the order of a sequence


def _best_pair(hist: Histogram, room: int, own: dict[int, int]) -> tuple[int, int] | None:
    """Two further lengths with the largest sum up to ``room``."""
    best, pair = 0, None
    j = len(hist.lengths) - 1
    for i, a in enumerate(hist.lengths):
        j = max(j, i)
        while j > i and a + hist.lengths[j] > room:
            j -= 1
        for k in range(j, i - 1, -1):
            b = hist.lengths[k]
            if a + b <= best:
                break
            spare_a = hist.left[a] - own.get(a, 0) - (a == b)
            if a + b <= room and spare_a > 0 and hist.left[b] > own.get(b, 0):
                best, pair = a + b, (a, b)
                break
        if 2 * a > room:
            break
    return pair


def dominating_set(hist: Histogram, capacity: int, j: int) -> tuple[int, ...] | None:
    """Lengths that some optimal packing puts together with one of length ``j``; or None.

    Martello and Toth's criterion for sets of up to three. No other set with
    j can be better than {j} if nothing fits beside it; than {j, i} with the largest i that fits, if
    i fills it up, if no two fit, or if no three fit and i is as long as the best two together; than
    {j, a, b} with the best two (a the longer), if no three fit, a is the largest that fits alone and no
    two of those between a and b fit.
    """
    room, own = capacity - j, {j: 1}
    i = hist.largest_to(room, own)
    if i is None:
        return (j,)
    low = hist.smallest(3, own)
    if i == room or sum(low[:2]) > room:
        return (j, i)
    if sum(low) > room:
        b, a = sorted(_best_pair(hist, room, own))
        if i >= a + b:
            return (j, i)
        if a == i and sum(hist.smallest(2, {j: 1, a: 1 + (a == j)}, above=b)) > room:
            return (j, a, b)
    return None


def reduce_instance(hist: Histogram, capacity: int) -> list[tuple[Pattern, int]]:
    """Fixes dominating sets and takes them out of ``hist``, from the largest length to the smallest.

    A length without such a set is passed over; what is fixed after it may leave one for it, so the lengths are
    gone through until nothing more is found.
    """
    fixed: list[tuple[Pattern, int]] = []
    before = -1
    while before < len(fixed):
        before = len(fixed)
        for j in hist.lengths[::-1]:
            while j in hist.left and (found := dominating_set(hist, capacity, j)):
                need = {s: found.count(s) for s in found}
                # As long as the counts last, the same set is found again, but for the criteria that look
                # at the smallest lengths: what is taken only leaves larger ones, which they still meet.
                n = min(hist.left[s] // k for s, k in need.items())
                for s, k in need.items():
                    hist.take(s, n * k)
                fixed.append((tuple(need.items()), n))
    return fixed


def best_fit(hist: Histogram, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing over lengths: sequences with the same contents are one group."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}  # room → groups of sequences
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if n:
            if room not in open_:
                rooms.insert(bisect_left(rooms, room), room)
            open_.setdefault(room, []).append((pattern, n))

    for length in reversed(hist.lengths):
        left = hist.left[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, pattern, n = capacity, (), left  # as many new ones as could be needed
            each = room // length
            full = min(n, left // each)
            put(room - each * length, (*pattern, (length, each)), full)
            left, n = left - full * each, n - full
            if left and n:
                put(room - left * length, (*pattern, (length, left)), 1)
                left, n = 0, n - 1
            if pattern:
                put(room, pattern, n)
    return [group for groups in open_.values() for group in groups]


@dataclass(frozen=True)
class Slots:
    """Where the pieces of one length go: ranks from ``first[i]`` to ``each[i]`` a sequence."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, Slots], int, int]:
    """Slots by length for a histogram of lengths, the number of sequences, and of pieces that the reduction fixed."""
    hist = Histogram(counts, capacity)
    reduced = reduce_instance(hist, capacity)
    fixed = sum(n * each for pattern, n in reduced for _, each in pattern)
    groups = reduced + best_fit(hist, capacity)
    used: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, n in groups:
        offset = 0
        for length, each in pattern:
            rank = used.get(length, 0)
            slots.setdefault(length, []).append((rank, sequence, each, offset))
            used[length] = rank + n * each
            offset += length * each
        sequence += n
    if used != {s: n for s, n in counts.items() if n}:
        raise AssertionError("the packing lost pieces")
    return {s: Slots(*(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))) for s, rows in slots.items()}, sequence, fixed


def _ranks(rows: DataFrame, counts: dict[int, int]) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """``rows`` with a bucket and a number within length and bucket; where each bucket begins.

    A length has one bucket per BUCKET_ROWS pieces, so the buckets are at most capacity + pieces /
    BUCKET_ROWS.
    """
    sizes = rows.sparkSession.createDataFrame(
        [(s, 1 + n // BUCKET_ROWS) for s, n in counts.items()], "length long, buckets long"
    )
    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    bucketed = rows.join(F.broadcast(sizes), "length").withColumn("bucket", F.pmod(spread, "buckets"))
    starts: dict[tuple[int, int], int] = {}
    at: dict[int, int] = {}
    for length, bucket, n in bucketed.groupBy("length", "bucket").count().orderBy("length", "bucket").collect():
        starts[length, bucket] = at.get(length, 0)
        at[length] = starts[length, bucket] + n
    numbered = bucketed.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY length, bucket ORDER BY doc_id, piece, ids_crc32) - 1 AS number",
    )
    return numbered, starts


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of every document with ``sequence_id`` and ``offset``."""
    rows = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = {r.length: r["count"] for r in rows.groupBy("length").count().collect()}
    if not counts:
        return rows.selectExpr("*", "0L AS sequence_id", "0L AS offset")
    slots, sequences, fixed = pack(counts, capacity)
    log.info("%s sequences; the reduction fixed %s of %s pieces", sequences, fixed, sum(counts.values()))
    numbered, starts = _ranks(rows, counts)
    plan = rows.sparkSession.sparkContext.broadcast((slots, starts))

    def place(batches: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        slots, starts = plan.value
        for batch in batches:
            lengths, buckets = batch["length"].to_numpy(), batch["bucket"].to_numpy()
            ranks = batch["number"].to_numpy(dtype=np.int64) + np.array(
                [starts[key] for key in zip(lengths.tolist(), buckets.tolist(), strict=True)], dtype=np.int64
            )
            sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
            for length in np.unique(lengths):
                here, s = lengths == length, slots[int(length)]
                i = np.searchsorted(s.first, ranks[here], side="right") - 1
                nth = ranks[here] - s.first[i]
                sequence[here] = s.sequence[i] + nth // s.each[i]
                offset[here] = s.offset[i] + nth % s.each[i] * length
            out = batch[["doc_id", "piece", "start", "length", "ids_crc32"]]
            yield out.assign(sequence_id=sequence, offset=offset)

    kept = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "bucket", "number")
    return kept.mapInPandas(place, f"{PIECES}, sequence_id long, offset long")
