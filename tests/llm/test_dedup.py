"""Dedup operators against brute force: equal texts, repeated words and lines, near copies, leaks."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from nestweave.llm import decontaminate, exact_dedup, golay, line_dedup, minhash, simhash, substring_dedup
from nestweave.llm.common import components


def test_exact_dedup_and_index(spark, docs, corpus, none):
    index = exact_dedup.DigestIndex.create(spark, buckets=4)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(docs, index).collect()}
    groups = defaultdict(list)
    for i, t in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    assert got == {(i, min(g), len(g), i == min(g)) for g in groups.values() for i in g}
    assert index.rows().count() == len(groups)
    later = spark.createDataFrame([(500, corpus[0][1]), (501, "new text"), (None, "new text"), (None, "alone")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.deduplicate(later, index, "1").collect()}
    assert got == {(500, 0, False), (501, 501, True), (None, 501, False), (None, None, True)}
    assert index.rows().count() == len(groups) + 2
    exact_dedup.deduplicate(later, index, "1").collect()
    exact_dedup.deduplicate(none, index, "2").collect()
    assert index.rows().count() == len(groups) + 2


def repeated_words(corpus):
    """(doc_id, n_words, n_removed, sha256) by all windows of all documents."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in corpus]
    for i, w in sorted(split):
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    for i, w in split:
        gone = bytearray(len(w))
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < i:
                gone[p : p + 13] = b"\1" * 13
        kept = [x for x, g in zip(w, gone) if not g]
        yield i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()


@pytest.mark.parametrize("hot", [10**9, 0])
def test_substring_dedup(docs, corpus, none, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "SEGMENT", 1000)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    assert got == sorted(repeated_words(corpus))
    if not hot:
        assert substring_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [10**9, 0])
def test_substring_dedup_of_a_passage_repeated_in_one_document(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    rng = np.random.default_rng(11)
    rows = []
    for i in range(0, 60, 3):
        passage, a, b = (" ".join(f"p{x}" for x in rng.integers(0, 10**6, n)) for n in (30, 20, 20))
        # The words before the passage differ between the documents and are the same within the second.
        rows += [(i, f"{a} {passage}"), (i + 1, f"{b} {passage} {b} {passage} {b} {passage}"), (i + 2, f"{b} {passage} {b}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    assert got == sorted(repeated_words(rows))


@pytest.mark.parametrize("repeats", [10**9, 7])
def test_repeats_of_hot_blocks_meet_their_first_as_lists(spark, monkeypatch, repeats):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", 0)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "REPEATS", repeats)
    plain, met = substring_dedup.written, []

    def written(df, name):
        if name == "hot-repeats":
            plan = df._jdf.queryExecution().executedPlan().toString()
            met.append(plan[plan.index("Join") :])
        return plain(df, name)

    monkeypatch.setattr(substring_dedup, "written", written)
    rng = np.random.default_rng(31)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    passage = prose(30)
    rows = [(i, f"{prose(20)} {passage} {prose(15)} {passage if i % 5 == 0 else ''}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    assert got == sorted(repeated_words(rows))
    assert len(met) == 1 and "collect_list" in met[0]


@pytest.mark.parametrize("hot", [10**9, 0])
def test_words_over_and_over_are_one_hot_block(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "REPEATS", 7)
    monkeypatch.setattr(substring_dedup, "SEGMENT", 100)
    plain, made = substring_dedup.written, {}

    def written(df, name):
        made[name] = plain(df, name)
        return made[name]

    monkeypatch.setattr(substring_dedup, "written", written)
    rng = np.random.default_rng(41)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    # Pairs and triples of words, the first documents with few of them in a row, twice and cut off in the middle.
    rows = [(0, f"{prose(9)} {'a b ' * 9} {prose(5)} {'a b ' * 14} a {prose(9)}"), (1, f"{'x y z ' * 6} {prose(14)} {'x y z ' * 11} x y")]
    rows += [(i, f"{prose(i % 7)} {'a b ' * (i % 9 + 20 * (i % 3))} {prose(3)} {'x y z ' * (3 * i)} {prose(14)}") for i in range(2, 60)]
    rows += [(60, "b a " * 40 + "c " * 80), (61, "c " * 90), (61, "c " * 90), (61, "d c " * 30), (62, "c " * 13 + "d c " * 45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()))
    assert got == sorted(repeated_words(rows))
    if not hot:
        found = made["hot-repeats"].agg(F.count("*").alias("rows"), F.sum("times").alias("places")).first()
        assert found.rows * 5 < found.places

    texts = {i: t.split() for i, t in rows if i != 61}
    for f in substring_dedup.parse(docs.where("doc_id <> 61")).collect():
        assert f.ref_doc < f.doc_id and f.start + f.n_words <= len(texts[f.doc_id])
        assert texts[f.doc_id][f.start : f.start + f.n_words] == texts[f.ref_doc][f.ref_start : f.ref_start + f.n_words]


@pytest.mark.parametrize("hot", [10**9, 0])
def test_substring_dedup_of_repeated_ids(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 1)
    rng = np.random.default_rng(21)
    prose = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    a, b, c, d = prose(20), prose(40), prose(20), prose(14)
    first = " ".join(a.split()[:14])
    rows = [(1, a), (2, a), (2, f"z0 z1 z2 {first}"), (3, prose(20)), (4, b), (4, f"{c} {a}"), (4, f"{c} {a}"), (5, f"{d}  {c}"), (5, f"{d} {c}")]
    rows += [(6, d), (6, b), (None, a), (None, None), (7, None), (7, "")]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, variant int, several string").repartition(3)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=repr)
    named = [r for r in rows if r[0] is not None]
    want = list(repeated_words(named)) + [(None, n, 0, h) for _, n, _, h in repeated_words([(i, t) for i, (x, t) in enumerate(rows) if x is None][:1])]
    want += [(None, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert got == sorted(want, key=repr)


def test_factors_are_copies(docs, corpus):
    texts = {i: (t or "").split() for i, t in corpus if i not in (60, 68, 70, 71)}
    rows = docs.where(~F.col("doc_id").isin(60, 68, 70, 71)).fillna("").select("doc_id", "text")
    found = substring_dedup.parse(rows).collect()
    assert found and all(f.n_words >= 13 and f.ref_doc < f.doc_id for f in found)
    for f in found:
        assert texts[f.doc_id][f.start : f.start + f.n_words] == texts[f.ref_doc][f.ref_start : f.ref_start + f.n_words]


def hash_of(text):
    """Spark's hash of a text, which orders rows of one id."""
    value = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def repeated_lines(rows, width, long=50):
    split = [((i, hash_of(t)), (t or "").split("\n")) for i, t in rows]
    first, counted = {}, {}
    for row, x in sorted(((r, x) for r, x in split if r[0] is not None)):
        counted[row] = [
            (p, w) for w in range(1, width + 1) for p in range(len(x) - w + 1)
            if w == width or len(re.findall("[^ \t-\r]+", " ".join(x[p : p + w]))) >= long
        ]
        for p, w in counted[row]:
            first.setdefault(tuple(x[p : p + w]), (row, p))
    for row, x in split:
        gone = {p + k for p, w in counted.get(row, ()) for k in range(w) if first[tuple(x[p : p + w])] < (row, p)}
        yield row[0], "\n".join(y for p, y in enumerate(x) if p not in gone), len(x), len(gone)


def line_rows():
    rng = np.random.default_rng(3)
    rows = [(int(i), "\n".join(rng.choice(list("abcde"), rng.integers(0, 30)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "\n\n\n\n"), (83, "\n\n\n"), (5, rows[5][1]), (None, rows[5][1]), (84, "x\n" * 5000)]
    # Rows that repeat an id with other texts: nothing of one goes for what the other has lost.
    rows += [(90, "p\n" * 5), (91, "p\n" * 5), (91, "q\n" * 7), (91, "p\np\np\nr"), (90, "s\nt\nu")]
    one, two, half = " ".join(["many"] * 60), " ".join(["more"] * 49), " ".join(["few"] * 25)
    rows += [(100, f"a\n{one}\nb"), (101, one), (102, f"{one}\n{two}"), (103, f"x\n{two}\ny"), (104, two), (105, f"{half}\n{half}"), (106, f"h\n{half}\n{half}\nk")]
    return [*rows, (107, f"{half}\nz\n{half}"), (108, f"{half}  \n{half}")]


@pytest.mark.parametrize("width", [1, 3, 4])
def test_line_dedup(spark, none, width):
    rows = line_rows()
    frame = spark.createDataFrame([(*r, "line", 7) for r in rows], "doc_id long, text string, line string, text_hash int").repartition(4)
    got = line_dedup.remove_repeated_runs(frame, width).collect()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(repeated_lines(rows, width), key=key)
    assert line_dedup.remove_repeated_runs(none, width).count() == 0
    assert "Python" not in line_dedup.remove_repeated_runs(frame, width)._jdf.queryExecution().toString()


def test_line_dedup_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST", 0)
    rows = line_rows()
    got = line_dedup.remove_repeated_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(repeated_lines(rows, 3), key=str)


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    flips = (1 << rng.integers(0, 23, 2000)) ^ (1 << rng.integers(0, 23, 2000))
    for a, b in zip(golay.codeword_indices(words), golay.codeword_indices(words ^ flips)):
        assert {x for x in a if x >= 0} & {x for x in b if x >= 0}


def near_components(corpus):
    def fp(t):
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {(i, t): fp(t) for i, t in set(corpus)}
    return closed([(i, f) for (i, _), f in prints.items()])


def closed(items):
    root = {f: f for _, f in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(root)
    for n, a in enumerate(keys):
        for b in keys[:n]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, f in items:
        least[find(f)] = min(i, least.get(find(f), i))
    return {(i, f"{f:016x}", least[find(f)]) for i, f in items}


def test_simhash(docs, corpus, none):
    rows = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert set(map(tuple, rows.collect())) == near_components(corpus)
    assert rows.count() == len(corpus)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("most", [2, 64])
def test_links_of_dense_clusters(spark, most):
    rng = np.random.default_rng(5)
    prints = {0, (1 << 64) - 1}
    for centre in rng.integers(0, 1 << 63, 30, dtype=np.uint64).tolist():
        for _ in range(20):
            centre ^= 1 << int(rng.integers(64))
            prints.add(centre)
    signed = [f - (1 << 64 if f >> 63 else 0) for f in prints]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    pairs = {tuple(sorted((a % (1 << 64), b % (1 << 64)))) for a, b in simhash.linked_pairs(frame, most).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    exact = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
    if most == 64:
        assert pairs <= exact
    named = [(f, f) for f in prints]
    roots = dict(map(tuple, components(simhash.linked_pairs(frame, most), "a", "b").collect()))
    got = defaultdict(set)
    for f in signed:
        got[roots.get(f, f)].add(f % (1 << 64))
    want = defaultdict(set)
    for i, _, c in closed(named):
        want[c].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_pipeline_near_copies(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(0, 120, 4):
        words = [f"W{x}" for x in rng.integers(0, 3000, 60 + i)]
        other, third, half = list(words), list(words), list(words)
        other[len(words) // 2] = "changed"  # a near copy whose fingerprint may differ in many bits
        third[5] = third[len(words) // 2] = "moved"
        half[::12] = ["far"] * len(half[::12])  # shares shingles, but too few
        rows += [(i + k, " ".join(w)) for k, w in enumerate([words, other, third, half])]
    rows += [(120, "a b"), (121, "A  b"), (122, ""), (123, None), (124, "a c"), (None, rows[0][1]), (125, rows[0][1])]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[p : p + 5]) for p in range(len(w) - 4)} or {tuple(w)}

    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(3)
    want = {i for i, r in root.items() if r == i} | {None}
    assert len(want) < len(rows) - 40
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame, "")
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == frame.columns
    assert corpus_pipeline.keep_one_of_near_copies(spark, frame.limit(0), "").count() == 0


def sets_of(rows):
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset(tuple(w[p : p + 5]) for p in range(len(w) - 4)) or frozenset({tuple(w)})

    return {row: shingles(row[1]) for row in rows if row[0] is not None}


def brute_near(rows):
    """row → (component_id, kept) of every row in a group of several, by all pairs."""
    sets = sets_of(rows)
    keys = sorted(sets, key=lambda r: (r[0], r[1] or ""))
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(keys):
        for b in keys[:n]:
            if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in keys:
        groups[find(k)].append(k)
    return {k: min(i for i, _ in g) for g in groups.values() if len(g) > 1 for k in g}


@pytest.mark.parametrize("with_original", [True, False])
def test_a_group_of_500_altered_copies(spark, with_original):
    """Copies with a few words changed each: near the original, mostly too far from one another to link."""
    rng = np.random.default_rng(12)
    original = [f"o{x}" for x in rng.integers(0, 10**6, 240)]
    rows = [(700, " ".join(original))] if with_original else []
    for i in range(500):
        words = list(original)
        for at in rng.choice(240, size=int(rng.integers(1, 9)), replace=False):
            words[at] = f"n{i}_{at}"
        rows.append((int(i * 2), " ".join(words)))
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_copies(frame).collect()}
    want = {i: c for (i, _), c in brute_near(rows).items()}
    assert got == want and len(want) > 300


def test_few_shared_bands_are_found_without_moving_all(spark, monkeypatch):
    plain, plans = minhash.written, {}

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(minhash, "written", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame([(i, f"a b c d e f g h i j {i // 2}") for i in range(8)], "doc_id long, text string")
        assert minhash.near_copies(frame).count() == 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans["shared-bands"]


def test_near_copies_with_repeated_ids(spark):
    rng = np.random.default_rng(13)
    prose = lambda n: " ".join(f"p{x}" for x in rng.integers(0, 10**6, n))
    a, b, c = prose(60), prose(60), prose(80)
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (3, c), (3, c + " x"), (3, a.upper()), (4, None), (4, ""), (5, "  "), (None, a), (6, prose(50))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minhash.near_copies(frame).join(frame.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").distinct(), ["doc_id", "text_hash"])
    got = {(r.doc_id, r.text or ""): r.component_id for r in found.collect()}
    want = {(i, t or ""): c for (i, t), c in brute_near([(i, t or "") for i, t in rows]).items()}
    # Equal rows are a group of their own in the answer, and the pipeline's exact dedup leaves one of them.
    got.pop((2, b), None)
    want.pop((2, b), None)
    assert got == want
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame, "")
    assert sorted(kept.collect(), key=repr).count((2, b)) == 2
    assert {tuple(r) for r in kept.collect()} & {(2, a + " more"), (3, a.upper()), (3, c + " x"), (3, c)} in ({(3, c)}, {(3, c + " x")})


def test_pipeline_near_copies_by_fingerprint_and_over_chains(spark):
    """Texts within two bits of SimHash are near copies too, whatever their Jaccard, also over chains of both kinds of link."""
    rng = np.random.default_rng(15)
    jaccard = lambda a, b: len(a & b) / len(a | b)

    def altered(words):
        """Within two bits, but too far apart for five-word shingles."""
        sets = sets_of([(0, " ".join(words))]).popitem()[1]
        while True:
            other = list(words)
            for at in rng.choice(len(words), size=8, replace=False):
                other[at] = f"n{rng.integers(10**6)}"
            bits = simhash.fingerprint_of(" ".join(words)) ^ simhash.fingerprint_of(" ".join(other))
            if bits.bit_count() <= 2 and jaccard(sets, sets_of([(0, " ".join(other))]).popitem()[1]) < 0.78:
                return other

    a, b, alone = ([f"s{x}" for x in rng.integers(0, 10**6, 260)] for _ in range(3))
    far, chained = altered(a), altered(b)
    link = [*b[:200], "x", *b[201:]]  # by its Jaccard near b, which is within two bits of the smallest
    rows = [(1, a), (2, far), (5, b), (4, link), (3, chained), (6, alone), (None, a)]
    frame = spark.createDataFrame([(i, " ".join(w), 1) for i, w in rows], "doc_id int, text string, n int").repartition(3)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, " ".join(w)) for i, w in rows if i in (None, 1, 3, 6))
    # Rows that repeat an id are told apart.
    same = [(1, a), (1, far), (2, b), (2, link), (2, alone)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in same], "doc_id long, text string").repartition(3)
    texts = {r.text for r in corpus_pipeline.keep_one_of_near_copies(spark, frame, "").collect()}
    assert len(texts) == 3 and len(texts & {" ".join(a), " ".join(far)}) == len(texts & {" ".join(b), " ".join(link)}) == 1


def test_pipeline_stages_tell_rows_apart(spark, sf_dir):
    rng = np.random.default_rng(14)
    prose = lambda n: " ".join(f"q{x}" for x in rng.integers(0, 10**6, n))
    a, b = prose(40), prose(40)
    rows = [(1, a, {"k": 1}), (2, a, None), (2, b, None), (2, b, {"k": 2}), (3, None, None), (4, "", None), (None, a, None), (None, a, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _row map<string, int>")
    kept = corpus_pipeline.keep_first_copies(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, a), (2, b), (3, None), (None, a), (None, a)], key=repr)
    benchmark = spark.createDataFrame([(1, b)], "item_id long, text string")
    benchmark.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/bench/benchmark.parquet")
    clean = corpus_pipeline.keep_uncontaminated(spark, frame, f"{spark.conf.get('spark.checkpoint.dir')}/bench")
    assert clean.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted((i or 0, t or "") for i, t, _ in rows if t != b)
    for stage in (corpus_pipeline.keep_first_copies, corpus_pipeline.keep_one_of_near_copies, corpus_pipeline.keep_uncontaminated):
        assert stage(spark, frame.limit(0), sf_dir).count() == 0


def test_decontamination(spark, none):
    rng = np.random.default_rng(2)
    prose = lambda n: [f"W{x}" for x in rng.integers(0, 5000, n)]
    items = [(i, prose(n)) for i, n in enumerate([3, 5, 9, 30, 31, 64, 65, 200])] + [(8, []), (9, prose(40))]
    texts = []
    for i in range(60):
        words = prose(int(rng.integers(0, 400)))
        if i % 3 == 0:
            own = list(items[i // 3 % 10][1])
            if i % 2 and len(own) > 20:
                own[len(own) // 2] = "changed"
            words[5:5] = own
        texts.append((i, " ".join(words)))
    texts += [(60, " ".join(items[0][1]).lower()), (61, None), (62, ""), (None, " ".join(items[3][1])), (0, texts[0][1])]
    rows = [(i, " ".join(w)) for i, w in items] + [(10, None), (None, "a b c d e f"), (11, " ".join(items[3][1]))]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[p : p + 5]) for p in range(len(w) - 4)} or ({tuple(w)} if w else set())

    want = set()
    for i, t in texts:
        for j, q in rows:
            a, b = shingles(t), shingles(q)
            if i is not None and j is not None and b and len(a & b) * 100 >= 80 * len(b):
                want.add((i, j, len(a & b), len(b), len(a & b) / len(b)))
    assert len(want) > 15
    frame = spark.createDataFrame([(*r, 1) for r in texts], "doc_id long, text string, n int")
    asked = spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, need string")
    found = decontaminate.find_contained(frame, asked)
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "Python" not in found._jdf.queryExecution().toString()
    assert decontaminate.find_contained(none, asked).count() == 0
    assert decontaminate.find_contained(frame, asked.limit(0)).count() == 0
