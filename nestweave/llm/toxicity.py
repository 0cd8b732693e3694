"""Toxicity (9): a linear classifier that is held to equal scores when an identity term is swapped.

Features are words and the beginnings of words (inflected forms share one), taken where they are
clearly commoner in toxic texts. The weights minimise the logistic loss of the labels, a small
ridge, and ``pairing`` times the squared change of the logit between a labelled text and its
counterfactuals: the same text with the identity terms of a group swapped for others of the group.
A group that is merely mentioned in many toxic examples then cannot carry weight of its own.

Counting and scoring run on the executors over whole texts. The fit itself sees at most ``SAMPLE``
labelled rows (those with the smallest hash of their id), ``FEATURES`` features and their
counterfactuals, so what reaches the driver is bounded.

Defined results: a null or empty text gets the score of no evidence; of several labels of one
document the highest counts; rows without an id are scored and never learnt from; without
labelled rows of both classes the score is the share of toxic ones, 0 without any label; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.llm.common import texts

#: Labelled rows to learn from, at most.
SAMPLE = 20_000
#: Features, at most: those that tell the classes apart best.
FEATURES = 4096
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6)
#: A feature is taken from this z-score of its class shares and this ratio of them on.
MIN_Z, MIN_RATIO = 4.0, 3.0
PAIRING, RIDGE, STEPS = 1.0, 1e-4, 400

#: Identity terms by group; a term is swapped for the others of its group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "atheist"),
    ("muslims", "christians", "jews", "hindus", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "citizens", "refugees"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """The word, and its beginnings with a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def document_features(found: set[str]) -> set[str]:
    return {f for w in found for f in features_of(w)}


def counterfactuals(found: set[str], groups: Sequence[Sequence[str]]) -> list[set[str]]:
    """The words of a text with one group's terms swapped, once for every other term of the group."""
    out = []
    for group in groups:
        present = found.intersection(group)
        for term in group if present else ():
            if present != {term}:
                out.append(found - present | {term})
    return out


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]

    def scorer(self):
        """A function of a text, with what it needs to pass over most words at once."""
        whole = {f for f in self.weights if not f.endswith("*")}
        starts = {f[:-1][: BEGINNINGS[0]] for f in self.weights if f.endswith("*")}
        first, weights = BEGINNINGS[0], self.weights

        def score(text: str) -> float:
            found = words_of(text)
            some = [w for w in found if w in whole or w[:first] in starts]
            logit = self.bias + sum(weights.get(f, 0.0) for f in document_features(set(some)))
            return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))

        return score


def learnable(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labels that may be learnt from, one row per document."""
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("toxic").isNotNull() & (part != 0))
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    pairing: float = PAIRING,
    sample: int = SAMPLE,
) -> Model:
    """Learns from the labelled rows of ``docs``."""
    chosen = learnable(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = rows.persist()
    try:
        totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
        clean, toxic = totals.get(0, 0), sum(n for t, n in totals.items() if t)
        if not clean or not toxic:
            share = toxic / (clean + toxic) if clean + toxic else 0.0
            share = min(max(share, 1e-9), 1 - 1e-9)
            return Model(float(np.log(share / (1 - share))), {})
        names = _select(rows, clean, toxic)
        return _train(rows, names, identity_terms, pairing)
    finally:
        rows.unpersist()


def _select(rows: DataFrame, clean: int, toxic: int) -> list[str]:
    """The features that are clearly commoner in toxic texts, best first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                found[int(label > 0)].update(document_features(words_of(text)))
            every = list(found[0] | found[1])
            yield pd.DataFrame({"feature": every, "a": [found[1][f] for f in every], "b": [found[0][f] for f in every]})

    counts = rows.mapInPandas(count, "feature string, a long, b long")
    counts = counts.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a >= 3")
    in_toxic, in_clean = F.col("a") / toxic, F.col("b") / clean
    both = (F.col("a") + F.col("b")) / (clean + toxic)
    z = (in_toxic - in_clean) / F.sqrt(both * (1 - both) * (1 / clean + 1 / toxic) + 1e-12)
    ratio = ((F.col("a") + 0.5) / toxic) / ((F.col("b") + 0.5) / clean)
    kept = counts.withColumn("z", z).where((F.col("z") >= MIN_Z) & (ratio >= MIN_RATIO))
    return [r.feature for r in kept.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()]


def _train(rows: DataFrame, names: list[str], groups: Sequence[Sequence[str]], pairing: float) -> Model:
    index = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ids(found: set[str]) -> list[int]:
            return sorted(index[f] for f in document_features(found) if f in index)

        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                found = words_of(text)
                out.append((int(label > 0), ids(found), [ids(x) for x in counterfactuals(found, groups)]))
            yield pd.DataFrame(out, columns=["toxic", "own", "swapped"])

    examples = rows.mapInPandas(encode, "toxic int, own array<int>, swapped array<array<int>>")
    # Equal examples are one row with a weight, in a fixed order, so that a fit can be repeated.
    grouped = examples.groupBy("toxic", "own", "swapped").count().collect()
    grouped.sort(key=lambda r: (r.toxic, r.own, r.swapped))
    weight = np.array([r["count"] for r in grouped], dtype=float)
    label = np.array([r.toxic for r in grouped], dtype=float)
    at = np.concatenate([np.full(len(r.own), i) for i, r in enumerate(grouped)]).astype(int)
    feature = np.concatenate([r.own for r in grouped]).astype(int)
    changes = [(r["count"], r.own, x) for r in grouped for x in r.swapped if x != r.own]
    pair = np.array([i for i, (_, a, b) in enumerate(changes) for _ in (*a, *b)], dtype=int)
    signs = np.array([s for _, a, b in changes for s in [1.0] * len(a) + [-1.0] * len(b)])
    pair_feature = np.array([f for _, a, b in changes for f in (*a, *b)], dtype=int)
    pair_weight = np.array([n for n, _, _ in changes], dtype=float)

    theta = np.zeros(len(names) + 1)
    share = (weight * label).sum() / weight.sum()
    theta[-1] = np.log(share / (1 - share))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        logit = np.bincount(at, theta[feature], len(label)) + theta[-1]
        error = weight * (1 / (1 + np.exp(-logit)) - label) / weight.sum()
        gradient = np.append(np.bincount(feature, error[at], len(names)), error.sum())
        gradient[:-1] += 2 * RIDGE * theta[:-1]
        if len(changes):
            gap = np.bincount(pair, signs * theta[pair_feature], len(changes)) * pair_weight / pair_weight.sum()
            gradient[:-1] += 2 * pairing * np.bincount(pair_feature, signs * gap[pair], len(names))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(float(theta[-1]), {f: float(theta[i]) for f, i in index.items()})


def score(text: Column, model: Model) -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf(T.DoubleType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for batch in batches:
            yield pd.Series([one(x) for x in batch], dtype="float64")

    return of(F.coalesce(text.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model = fit(docs, labels)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = texts(docs).select("doc_id", held_out.alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
