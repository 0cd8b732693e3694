"""Collocations, spelling variants and quality rules against brute force over all rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestweave.llm import collocations, quality_rules, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations ---


def brute_phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= 100 * candidates[p[i:j]]:
                        hidden.add(p[i:j])
        scored = []
        for p, a in candidates.items():
            if p not in hidden:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, n[lang], -score


def phrase_rows():
    rng = random.Random(5)
    words = ["the", "The", "oak", "é", "É", "#", "a_b", "x-y", "über", "tree", "b", "c"]
    rows = []
    for i in range(200):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice([*words, "new york city hall", "of the of the of"]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"])
        rows.append((rng.choice(["en", "en", "fr", None, ""]), text))
    rows += [("en", None), ("en", ""), (None, " .,"), ("fr", "hot words " * 3000)]  # a hot prefix, a long piece
    return rows


@pytest.mark.parametrize(("budget", "top"), [(collocations.BUDGET, 2000), (50, 7)])
def test_collocations(spark, budget, top):
    rows = phrase_rows()
    frame = spark.createDataFrame([(i, t, x, 0, "z") for i, (x, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, rank string")
    got = collocations.mine(frame.repartition(6), least=20, top=top, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_phrases(rows, 20, top))


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.mine(none).count() == 0
    assert collocations.mine(spark.createDataFrame([(1, None, None), (2, "", "en")], none.schema)).count() == 0


def test_blocks_of_a_long_text_give_every_suffix_once(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 50)
    text = " ".join(f"w{i % 37}" for i in range(500)) + ". end of it"
    words = [x for part in collocations._blocks(text.encode()) for x in part]
    assert words == text.replace(".", " .").encode().split()

    class Batch:
        def column(self, name):
            import pyarrow as pa

            return {"lang": pa.array(["en"]), "text": pa.array([text.encode()])}[name]

    (_, ids, begins), = collocations._chunks(iter([Batch()]))
    hashes = collocations._Hashes()
    want = [hashes[w] for w in words]
    places = np.flatnonzero(begins)
    assert len(places) == len([w for w in want if w])
    got = sorted(tuple(ids[p : p + 5].tolist()) for p in places)
    want += [0] * 5
    assert got == sorted(tuple(want[i : i + 5]) for i, w in enumerate(want) if w)


def test_scores_beyond_64_bits(spark):
    a, n = 3 * 10**12, 10**15
    phrases = spark.createDataFrame([(1, [1, 2], a)], "lang_key long, key array<long>, a long")
    singles = spark.createDataFrame([(1, 1, a + 1), (1, 2, a + 7)], "lang_key long, h long, n long")
    totals = spark.createDataFrame([(1, n)], "lang_key long, n long")
    row = collocations._scored(phrases, singles, totals).first()
    assert (row.l, row.r, row.score) == (a + 1, a + 7, 1000 * a * n // ((a + 1) * (a + 7)))


# --- spelling variants ---


def one_edit(x, y):
    if x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) < len(y):
        x, y = y, x
    return any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def brute_variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(x, w)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 10 * counts[w]:
            form[w] = best
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None


def spelling_rows():
    rng = random.Random(2)
    stems = ["".join(rng.choice("abcdeéñÿÀ") for _ in range(rng.randrange(6, 13))) for _ in range(25)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(80)):
            w = list(rng.choice(stems))
            while rng.random() < 0.3:
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1])] = rng.choice(["", "a", "b", "é"])
                w = w or ["a"]
            words.append("".join(w) if rng.random() < 0.8 else "".join(w).upper())
        rows.append((i, rng.choice([" ", "1", "-", "\n"]).join(words)))
    long = "q" * 300
    rows += [(500, None), (501, ""), (502, "-- 12"), (503, f"{long} {long} {long}q {long}q {long}z {long[:-1]}z {long[:-1]}z {long}z")]
    rows += [(7, rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]
    # Chains of forms, and words that have two best near words.
    rows += [(600 + i, "mountain " * 40) for i in range(100)] + [(800 + i, "mountaim " * 6) for i in range(10)]
    rows += [(830 + i, "mountaims " * 2 + "fountain " * 2) for i in range(2)]
    return rows


@pytest.mark.parametrize("most", [None, 20])
def test_spelling_variants(spark, most):
    rows = spelling_rows()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = sorted(map(tuple, spelling.group_variants(frame, most).collect()))
    want = sorted(brute_variants(rows))
    assert got == want
    assert any(x[1] and x[1] != x[2] for x in want)  # a form that has a form


def test_subtrees_are_cut_and_asked_once(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randrange(7, 10))) for _ in range(600)})
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    cut = spelling._cut(frame, 10)
    assert cut
    asked = spelling._asked(frame, cut)
    assert asked.where("own").groupBy("word").count().where("count <> 1").isEmpty()
    assert asked.where("own").count() == len(words)
    assert asked.groupBy("word", "subtree").count().where("count > 1").isEmpty()


def test_spelling_of_nothing(spark, none):
    assert spelling.group_variants(none).count() == 0
    assert spelling.group_variants(spark.createDataFrame([(1, None), (2, "word")], none.schema)).count() == 0


# --- quality rules ---


def brute_measures(text):
    text = text or ""
    words = re.findall("[^ \t-\r]+", text)
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    base = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    chars, symbols = sum(map(len, words)), len(re.findall("[#*$%&|<>]", text))
    again = len(lines) - len(set(lines))
    bad = (
        base
        or 10 * symbols > len(words)
        or not 3 * len(words) <= chars <= 10 * len(words)
        or 2 * again > len(lines)
        or 100 * len(re.findall("[A-Z]", text)) > 30 * chars
        or 5 * sum(not re.search("[A-Za-zÀ-ɏ]", w) for w in words) > len(words)
        or 5 * sum(a == b for a, b in zip(words, words[1:])) > len(words)
    )
    return len(words), chars, symbols, again, len(repeated), base, not bad


def quality_texts():
    rng = random.Random(9)
    pool = [f"wörd{i}" for i in range(300)]

    def prose(n, *more):
        return " ".join(rng.choice([*pool, *more]) for _ in range(n))

    rows = [prose(rng.randrange(40, 200)) for _ in range(40)]
    rows += [prose(100, "#", "*&*") for _ in range(4)] + [prose(80, *["|"] * 150) for _ in range(4)]
    rows += [prose(120).upper(), " ".join(["a b"] * 60), (prose(30) + "\n") * 5, "x " * 80, " ".join(w + " " + w for w in pool[:60])]
    rows += [prose(60) + "\n" + "same line\n" * 4, None, "", " \n\t ", "one", "a b c a b c", "𝔘 " * 60, "\x0b".join(pool[:70])]
    rows += [" ".join(pool[i % 300] + str(i) for i in range(60_000))]
    return rows + rows[:2]


def test_quality_rules(spark):
    texts = quality_texts()
    rows = [(None if i == 3 else i % 90, t, -1, "k", i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string, row int").repartition(6)
    got = quality_rules.judge(frame)
    columns = ["row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert "Python" not in got._jdf.queryExecution().toString()
    rows = got.select(*columns, "rejected_by").collect()
    assert sorted(tuple(r)[:-1] for r in rows) == [(i, *brute_measures(t)) for i, t in enumerate(texts)]
    assert all((r.rejected_by is None) == r.kept for r in rows)
    assert len({r.rejected_by for r in rows}) >= 7
    reverse = [quality_rules.Estimate(r, 1.0, 0.0) for r in reversed(quality_rules.RULES)]
    other = quality_rules.judge(frame, order=reverse).select(*columns).collect()
    assert sorted(map(tuple, other)) == sorted(tuple(r)[:-1] for r in rows)


def test_quality_of_nothing(spark, none):
    assert quality_rules.judge(none).count() == 0


def test_cascade_order_and_short_circuit(spark):
    rules = [quality_rules.Rule(n, lambda n=n: F.col("text") == n) for n in "abc"]
    # b rejects most per cost; of what is left, c rejects more than a for the same cost.
    found = quality_rules._greedy(rules, [1.0, 0.5, 1.0], [(1, 1, 0, 10), (0, 0, 1, 4), (1, 0, 0, 3), (0, 0, 0, 83)])
    assert [e.rule.name for e in found] == ["b", "c", "a"]
    assert [round(e.rejected, 3) for e in found] == [0.1, 0.044, 0.035]
    late = quality_rules.Rule("late", lambda: F.raise_error(F.lit("evaluated")).cast("boolean"))
    first = quality_rules.Rule("first", lambda: F.col("n_words") < 50)
    order = [quality_rules.Estimate(r, 1.0, 0.0) for r in (first, late)]
    frame = spark.createDataFrame([("short",)], "text string")
    assert quality_rules.judge(frame, order=order).first().rejected_by == "first"
    with pytest.raises(Exception, match="evaluated"):
        quality_rules.judge(spark.createDataFrame([("w " * 60,)], "text string"), order=order).collect()


def test_quality_keeps_what_labels_call_good(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judge(docs).where("NOT base_failed").join(labels, "doc_id")
    wrong = rows.where("(quality = 1) <> kept").count()
    assert rows.count() > 200 and wrong == 0
