"""Quality rules (13): a short-circuit cascade, its rules ordered by rejection per cost on a sample.

Every rule is one expression over a row of :func:`measured`. A sample of at most ``SAMPLE_ROWS`` rows is
measured once: each rule's cost by the time it takes over that sample, in one task so that scheduling counts
for all alike, and its selectivity by the rows it rejects there. The next rule is always the one that
rejects most of what the earlier ones leave per unit of cost. The cascade is one ``CASE``: a rule is
evaluated only where all before it passed, and in no order does a row get another verdict.

The measures themselves are expressions on the row, so a table is read once, and nothing is shuffled. A
three-word window is known by 64 bits of its hash; two windows of one text share one by chance with a
probability below 1e-7 up to a million words.

Defined results: a null or empty text has no words and no lines, fails the base rules and isn't kept; a
very long text is one row like any other; a row without ``doc_id`` or one that repeats it is judged like any
other; equal rejection per cost is ordered by the rule's name; an empty table gives no rows and the rules
in their given order; of other columns only those of the result's names are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.llm.common import SPACE, written

#: Rows of the sample on which costs and selectivities are estimated, about; it decides the order only.
SAMPLE_ROWS = 2000
#: Times that a rule is run on the sample; the least time counts.
RUNS = 2
#: Least cost of a rule in seconds per sample: shorter times are noise.
LEAST_COST = 0.002

_SYMBOLS = r"[#*$%&|<>]+"
_CAPITALS = "[A-Z]+"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """A row is rejected where ``rejects`` is true; it may use ``text`` and the measures."""

    name: str
    rejects: Callable[[], Column]


def _characters(text: Column, of: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, of, ""))


def _share(part: Column, percent: int, whole: Column) -> Column:
    """``part`` is more than ``percent`` hundredths of ``whole``."""
    return part * 100 > whole * percent


def _lettered_words() -> Column:
    """Words with a letter of the Latin alphabet, accents included: a blank and what goes up to the letter."""
    bare = F.concat(F.lit(" "), F.col("text"))
    return F.size(F.regexp_extract_all(bare, F.lit(r"[\x20\x09-\x0D][^\x20\x09-\x0DA-Za-zÀ-ɏ]*[A-Za-zÀ-ɏ]"), 0))


def _stutters() -> Column:
    """Words equal to the one before them."""

    def count(words: Column) -> Column:
        return F.size(F.filter(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.get(words, i) == F.get(words, i - 1)))

    return _let(F.col("words"), count)


#: What a document must not have more of than given; all rules hold for every language.
RULES = (
    Rule("too_short", lambda: F.col("n_words") < 50),
    Rule("repeated_windows", lambda: _share(F.col("n_repeat_words"), 50, F.col("n_words"))),
    Rule("symbols", lambda: _share(F.col("n_symbols"), 10, F.col("n_words"))),
    Rule("word_length", lambda: (F.col("word_chars") < F.col("n_words") * 3) | (F.col("word_chars") > F.col("n_words") * 10)),
    Rule("repeated_lines", lambda: _share(F.col("n_dup_lines"), 50, F.col("n_lines"))),
    Rule("capitals", lambda: _share(_characters(F.col("text"), _CAPITALS), 30, F.col("word_chars"))),
    Rule("words_without_letters", lambda: _share(F.col("n_words") - _lettered_words(), 20, F.col("n_words"))),
    Rule("stuttering", lambda: (F.col("n_words") > 1) & _share(_stutters(), 20, F.col("n_words"))),
)
BASE = ("too_short", "repeated_windows")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(words: Column) -> Column:
    """Words in windows that the text has twice or more."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]),
    )

    def places(ordered: Column) -> Column:
        """Where windows begin that stand beside an equal one in the order of their hashes."""

        def again(x: Column, i: Column) -> Column:
            beside = [F.get(ordered, i + k).getField("hash") for k in (-1, 1)]
            return F.coalesce(x["hash"] == beside[0], F.lit(False)) | F.coalesce(x["hash"] == beside[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["at"]))

    def covered(at: Column) -> Column:
        width = F.lit(WINDOW)
        steps = F.transform(at, lambda p, i: F.least(width, F.coalesce(F.get(at, i + 1) - p, width)))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def count(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, _let(_let(ordered, places), covered)).otherwise(0)

    return F.when(F.size(words) >= WINDOW, _let(windows, count)).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` never null, its ``words`` and the measures that rules may use."""
    rows = docs.withColumn("text", F.coalesce(docs["text"].cast("string"), F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), "")).withColumn("_lines", lines)
    sizes = {
        "n_words": F.size("words"),
        "word_chars": F.length(F.regexp_replace("text", SPACE, "")),
        "n_symbols": _characters(F.col("text"), _SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        # Bound once: a filter on a measure that Spark moves below these columns would make the words anew for every place.
        "n_repeat_words": _let(F.col("words"), _repeated),
        "n_lines": F.size("_lines"),
    }
    return rows.withColumns({k: v.cast("long") for k, v in sizes.items()}).drop("_lines")


@dataclass(frozen=True)
class Estimate:
    """Of one rule: seconds over the sample, and the share that it rejects of what came to it."""

    rule: Rule
    cost: float
    rejected: float


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """The rules in the order of the cascade, estimated on about ``rows`` rows of ``docs``.

    The sample is drawn by a fixed seed from all rows, which reads the texts once more; it is measured where
    they are, written, and read by one task.
    """
    total = docs.count()
    if not total or not rules:
        return [Estimate(rule, LEAST_COST, 0.0) for rule in rules]
    some = docs.select("text").sample(min(1.0, rows / total), seed=13)
    some = written(measured(some), "rule-sample").coalesce(1)
    flags = [F.coalesce(rule.rejects(), F.lit(False)) for rule in rules]
    costs = [_seconds(some, flag) for flag in flags]
    idle = _seconds(some, F.lit(False))
    # Rows with equal answers are one; there are no more of them than rows in the sample.
    answers = some.select(*[f.cast("int").alias(f"r{i}") for i, f in enumerate(flags)])
    counted = [tuple(r) for r in answers.groupBy(*answers.columns).count().collect()]
    return _greedy(rules, [max(c - idle, LEAST_COST) for c in costs], counted)


def _seconds(rows: DataFrame, flag: Column) -> float:
    taken = []
    for _ in range(RUNS):
        began = time.perf_counter()
        rows.agg(F.count_if(flag)).collect()
        taken.append(time.perf_counter() - began)
    return min(taken)


def _greedy(rules: Sequence[Rule], costs: Sequence[float], counted: Sequence[tuple[int, ...]]) -> list[Estimate]:
    """Always the rule that rejects most per cost of what is left; ``counted`` has answers and a number of rows."""
    left, open_, found = list(counted), set(range(len(rules))), []
    while open_:
        there = sum(row[-1] for row in left)
        out = {i: sum(row[-1] for row in left if row[i]) for i in open_}
        # Without rejections on the sample the cheapest goes first.
        best = min(open_, key=lambda i: (-out[i] / costs[i], costs[i], rules[i].name))
        found.append(Estimate(rules[best], costs[best], out[best] / there if there else 0.0))
        left = [row for row in left if not row[best]]
        open_.remove(best)
    return found


def rejected_by(cascade: Sequence[Rule]) -> Column:
    """The first rule of ``cascade`` that rejects the row, or null; later ones are not evaluated."""
    found = F.lit(None).cast("string")
    for rule in reversed(cascade):
        found = F.when(F.coalesce(rule.rejects(), F.lit(False)), F.lit(rule.name)).otherwise(found)
    return found


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, order: Sequence[Estimate] | None = None) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``.

    Which of several rules ``rejected_by`` names depends on the order, hence on the sample; ``kept`` doesn't.
    """
    cascade = [e.rule for e in (ordered(docs, rules) if order is None else order)]
    base = [F.coalesce(rule.rejects(), F.lit(False)) for rule in RULES if rule.name in BASE]
    failed = base[0]
    for other in base[1:]:
        failed = failed | other
    rows = measured(docs).withColumn("base_failed", failed).withColumn("rejected_by", rejected_by(cascade))
    return rows.withColumn("kept", F.col("rejected_by").isNull() & ~F.col("base_failed")).drop("words")
