"""Spelling variant grouping (12): a trie of letter counts, searched with a budget of one more and one less.

Letters fall into ``GROUPS`` groups; a word's vector says how many letters it has of each. Words that
differ by one inserted, deleted or replaced letter have vectors with at most one count that is one higher
(the *surplus*) and at most one that is one lower (the *deficit*). The trie arranges words by one count
after the other. Its subtrees are the unit of distribution: every word is filed in the subtree of its
first counts and asks those that its budget reaches, 21 at most for four counts. In each the words that ask go
down the trie together, depth first; at every node those go on whose budget still pays for the step. Words
of the leaves that are reached are verified letter by letter.

A subtree of more than ``SUBTREE`` words is cut deeper, by four counts at a time, until its words share
all their counts: no group grows with the table but classes of words with the same letters.

Defined results: a null text has no words; rows without ``doc_id`` or with one that repeats count like any
other (without ``doc_id`` no letter is left out); very long texts and words are taken whole; of near words with the
same count the first in code-point order is the form; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import written

#: Fixed value: the letters that make up words.
LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form occurs at least so many times as often.
MORE = 10
#: One in so many (document, word) pairs has a letter left out.
THINNED = 31

GROUPS = 16
#: Groups in the order of the trie's levels: those first whose counts differ most. A letter's group is its
#: code point modulo GROUPS.
LEVELS = np.array([5, 1, 14, 4, 2, 9, 3, 15, 8, 12, 7, 13, 0, 6, 11, 10])
#: Counts that name a subtree at first, and more where it is cut.
DEPTH = 4
#: Words of a subtree from which it is cut deeper.
SUBTREE = 50_000
#: Subtrees that are cut, at most, by level; a share of all words below 1 / CUT is never cut.
CUT = 100_000
#: Pairs of a node's words and words that ask, up to which they are compared at once.
BLOCK = 1 << 18
#: Longest word that is verified in tables of letters; longer ones are verified one by one.
LONG = 64


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, counted over all occurrences."""
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        docs["doc_id"].cast("string").alias("doc_id"), docs["text"].cast("string").alias("text")
    ).select("doc_id", F.explode(F.regexp_extract_all(folded, F.lit(LETTERS), 0)).alias("run"))
    # A word of too few letters can't become one by leaving one out.
    runs = runs.where(F.length("run") >= LEAST_LENGTH)
    check = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    place = F.pmod(check, F.length("run")).cast("int")
    thinned = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    less = F.col("doc_id").isNotNull() & (F.pmod(check, F.lit(THINNED)) == 0)
    words = runs.select(F.when(less, thinned).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def vectors(words: list[str]) -> np.ndarray:
    """The counts of every word, one row each, in the order of the trie's levels."""
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    level = np.empty(GROUPS, dtype=np.int64)
    level[LEVELS] = np.arange(GROUPS)
    flat = np.bincount(row * GROUPS + level[letters % GROUPS], minlength=GROUPS * len(words))
    return flat.reshape(-1, GROUPS).astype(np.int32)


def steps(depth: int) -> np.ndarray:
    """All changes of ``depth`` counts within the budget: at most one surplus and one deficit."""
    eye = np.eye(depth, dtype=np.int32)
    both = (eye[:, None] - eye[None]).reshape(-1, depth)
    return np.unique(np.concatenate([eye, -eye, both]), axis=0)  # a surplus and a deficit in one place are none


def _names(counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of every row of counts and of its length; rows that differ may share one by chance only."""
    name = np.full(len(counts), counts.shape[1] + 1, dtype=np.uint64)
    for column in counts.T:
        name = (name ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def subtrees(counts: np.ndarray, cut: frozenset[int], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, names, whether it is their own) of the subtrees that the words ``counts`` ask.

    ``cut`` names subtrees that are cut deeper. A word asks every subtree that its budget reaches, its own too.
    """
    for step in steps(depth):
        near = counts[:, :depth] + step
        there = np.flatnonzero((near >= 0).all(1))
        names, own = _names(near[there]), np.full(len(there), not step.any())
        deeper = np.isin(names, np.fromiter(cut, np.int64, len(cut))) if cut and depth < GROUPS else np.zeros(len(names), bool)
        yield there[~deeper], names[~deeper], own[~deeper]
        if deeper.any():
            yield from _below(counts, there[deeper], near[there[deeper]], cut, depth)


def _below(counts: np.ndarray, rows: np.ndarray, prefix: np.ndarray, cut: frozenset[int], above: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The subtrees below ``prefix``, which ``rows`` have reached, with what is left of their budget."""
    depth = above + DEPTH
    spent = prefix - counts[rows, :above]
    surplus, deficit = (spent > 0).sum(1), (spent < 0).sum(1)
    for step in steps(DEPTH):
        paid = (surplus + (step > 0).sum() <= 1) & (deficit + (step < 0).sum() <= 1)
        tail = counts[rows, above:depth] + step
        there = np.flatnonzero(paid & (tail >= 0).all(1))
        near = np.concatenate([prefix[there], tail[there]], axis=1)
        names, at = _names(near), rows[there]
        own = (near == counts[at, :depth]).all(1)
        deeper = np.isin(names, np.fromiter(cut, np.int64, len(cut))) if depth < GROUPS else np.zeros(len(names), bool)
        yield at[~deeper], names[~deeper], own[~deeper]
        if deeper.any():
            yield from _below(counts, at[deeper], near[deeper], cut, depth)


def _cut(words: DataFrame, most: int) -> frozenset[int]:
    """Names of the subtrees above ``most`` words, at every depth that some are cut to."""

    def named(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_names(vectors(batch.column(0).to_pylist())[:, :depth]))], names=["subtree"])

    found: frozenset[int] = frozenset()
    for depth in range(DEPTH, GROUPS, DEPTH):
        names = words.select("word").mapInArrow(lambda batches, depth=depth: named(batches, depth), "subtree long")
        large = names.groupBy("subtree").count().where(F.col("count") > most)
        rows = large.orderBy(F.desc("count"), "subtree").limit(CUT).collect()
        if not rows:
            break
        found |= {r.subtree for r in rows}
    return found


def _asked(words: DataFrame, cut: frozenset[int]) -> DataFrame:
    """(subtree, own, word, n): every word once where it is filed and once in every other subtree that it asks."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [x for x in subtrees(vectors(batch.column("word").to_pylist()), cut) if len(x[0])]
            rows, names, own = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
            columns = [names, own, batch.column("word").take(rows), batch.column("n").take(rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["subtree", "own", "word", "n"])

    return words.mapInArrow(ask, "subtree long, own boolean, word string, n long")


class _Words:
    """Words as tables: letter counts, letters from the left, and the same from the right."""

    def __init__(self, words: list[str]):
        self.words = words
        self.counts = vectors(words)
        self.length = np.array([len(w) for w in words], dtype=np.int32)
        # Four marks for every count, as many set as letters, so that marks differ by no more than counts do.
        unary = (np.uint64(1) << np.minimum(self.counts, 4).astype(np.uint64)) - np.uint64(1)
        self.marks = (unary << np.arange(0, 4 * GROUPS, 4, dtype=np.uint64)).sum(1, dtype=np.uint64)
        width = min(LONG, int(self.length.max(initial=1)))
        raw = [w.encode("latin-1")[:width] for w in words]
        self.left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in raw), dtype=np.uint8).reshape(-1, width)
        raw = [w.encode("latin-1")[-width:] for w in words]
        self.right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in raw), dtype=np.uint8).reshape(-1, width)
        places = np.array([1, 1 << 8, 1 << 16], dtype=np.uint32)
        self.head, self.tail = self.left[:, :3] @ places, self.right[:, -3:] @ places


def _verified(w: _Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows (a, b) differ by exactly one letter inserted, deleted or replaced.

    What is alike at the left and at the right must cover all but one letter of the longer word.
    """
    gap = np.abs(w.length[a] - w.length[b])
    found = gap <= 1
    long = found & (np.maximum(w.length[a], w.length[b]) > LONG)
    short = np.flatnonzero(found & ~long)
    alike = []
    for table, order in ((w.left, slice(None)), (w.right, slice(None, None, -1))):
        differs = (table[a[short]] != table[b[short]])[:, order]
        alike.append(np.where(differs.any(1), differs.argmax(1), differs.shape[1]))
    most = np.maximum(w.length[a[short]], w.length[b[short]])
    # Equal words are alike from both ends, so they cover more than all.
    less = np.minimum(w.length[a[short]], w.length[b[short]])
    found[short] = (alike[0] < most) & (np.minimum(alike[0], less) + np.minimum(alike[1], less) >= most - 1) & (a[short] != b[short])
    found[long] = [one_apart(w.words[x], w.words[y]) for x, y in zip(a[long], b[long], strict=True)]
    return found


def one_apart(x: str, y: str) -> bool:
    """The two words differ by exactly one letter inserted, deleted or replaced."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > 1 or x == y:
        return False
    at = next((i for i, c in enumerate(y) if c != x[i]), len(y))
    return x[at + 1 :] == (y[at + 1 :] if len(x) == len(y) else y[at:])


def search(w: _Words, filed: np.ndarray, asking: np.ndarray, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking, near) rows of ``w``: the words filed under one node that are one letter apart from those asking.

    ``filed`` and ``asking`` have spent their budgets on levels above ``depth`` only as far as they may.
    """
    if not len(filed) or not len(asking):
        return
    if depth == GROUPS or len(filed) * len(asking) <= BLOCK or len(filed) <= 4:
        # A leaf, or few enough words to compare all their remaining counts at once.
        size = max(1, BLOCK * 4 // len(filed))
        for at in range(0, len(asking), size):
            some = asking[at : at + size]
            # At most one surplus and one deficit are at most two changes, and one letter more or less.
            near = np.bitwise_count(w.marks[filed] ^ w.marks[some][:, None]) <= 2
            near &= np.abs(w.length[filed] - w.length[some][:, None]) <= 1
            i, j = np.nonzero(near)
            a, b = some[i], filed[j]
            # A letter that differs leaves the first three or the last three as they are.
            alike = (w.head[a] == w.head[b]) | (w.tail[a] == w.tail[b])
            a, b = a[alike], b[alike]
            ok = _verified(w, a, b)
            yield a[ok], b[ok]
        return
    have, want = w.counts[filed, depth], w.counts[asking, depth]
    spent = w.spent[asking]
    for count in np.unique(have):
        change = count - want
        paid = (change == 0) | ((change == 1) & (spent[:, 0] == 0)) | ((change == -1) & (spent[:, 1] == 0))
        down, step = asking[paid], change[paid]
        before = w.spent[down]
        w.spent[down, 0] += step == 1
        w.spent[down, 1] += step == -1
        yield from search(w, filed[have == count], down, depth + 1)
        w.spent[down] = before


def _near(group: pa.Table) -> pa.Table:
    """Of one subtree: for every word that asked, its near words there, counted, and the most frequent of them."""
    words, n, own = group.column("word").to_pylist(), group.column("n").to_numpy(), group.column("own").to_numpy()
    w = _Words(words)
    w.spent = np.zeros((len(words), 2), dtype=np.int8)
    found = list(search(w, np.flatnonzero(own), np.arange(len(words))))
    a, b = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, int) for i in (0, 1))
    names = np.array(words, dtype=object)
    order = np.lexsort((names[b].astype(str), -n[b], a)) if len(a) else a
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    counts = np.diff(np.append(first, len(a)))
    return pa.table({
        "word": pa.array(names[a[first]].tolist(), pa.string()), "n_near": pa.array(counts, pa.int64()),
        "near": pa.array(names[b[first]].tolist(), pa.string()), "near_n": pa.array(n[b[first]], pa.int64()),
    })


def near_words(words: DataFrame, most: int | None = None) -> DataFrame:
    """(word, n_near, near, near_n) of every word of ``words`` (word, n) with a near word, ``near`` the most frequent."""
    if most is None:
        most = max(SUBTREE, words.count() // CUT)
    asked = _asked(words, _cut(words, most))
    parts = asked.groupBy("subtree").applyInArrow(_near, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", "best.near", (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form: the last that is reached. A form is at least MORE times as frequent
    as its word, so chains are short and never closed; every round doubles the steps."""
    reached = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = written(reached.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        if ahead.where("next IS NOT NULL").isEmpty():
            return ahead.select("word", "root")
        reached = ahead.select("word", "root")


def group_variants(docs: DataFrame, most: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = written(vocabulary(docs), "vocabulary")
    found = words.join(near_words(words, most), "word", "left")
    is_form: Column = F.col("near_n") >= F.col("n") * MORE
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    every = found.join(roots, "word", "left")
    return every.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
