"""Paths of any depth against the same walk in Python."""

import pytest
from pyspark.sql import functions as F

from nestweave.functions.paths import parse_path, values_at, with_value
from nestweave.operators.path_lookup import PathDomain, enrich_paths

SCHEMA = """
k int,
a array<struct<id: string, b: map<string, struct<id: string, n: int, c: array<struct<id: string, x: int>>>>>>,
s struct<t: struct<id: string, u: array<struct<v: int>>>>,
`odd.name` array<struct<`i.d`: string, w: array<struct<z: int>>>>
"""


def rows():
    c = [("c1", 1), None, (None, 2), ("c1", 3)]
    return [
        (1, [("a1", {"m": ("b1", 1, c), "o": ("b2", 2, []), "n": None}), ("a2", {}), ("a1", None), None], (("t1", [(1,), None]),), [("o1", [(1,), (2,)])]),
        (2, [], ((None, []),), []),
        (3, None, (None,), None),
        (4, [(None, {"p": (None, None, None), "q": ("b1", 9, [("zz", 0)])})], None, [(None, None), ("o2", [])]),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(2)


def plain(value):
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return value


def walk(holder, steps):
    """All values at ``steps`` of a dict, in order."""
    step, *rest = steps
    own = holder.get(step.name)
    if step.kind and own is None:
        return []
    inside = own if step.kind == "[]" else list(own.values()) if step.kind == "{}" else [own]
    if not rest:
        return inside
    return [v for x in inside if x is not None for v in walk(x, rest)]


PATHS = ["k", "a[].id", "a[].b{}.id", "a[].b{}.n", "a[].b{}.c[].id", "s.t.id", "s.t.u[].v", "`odd.name`[].`i.d`", "`odd.name`[].w[].z", "a[].b{}.c[]"]


@pytest.mark.parametrize("path", PATHS)
def test_values(docs, path):
    got = {r.k: plain(r.v) for r in docs.select("k", values_at(path).alias("v")).collect()}
    assert got == {r.k: walk(plain(r), parse_path(path)) for r in docs.collect()}


def put(holder, steps, keys, field_value, depth=0, found=None):
    """``holder`` with the value written at the end of ``steps``."""
    holder = dict(holder)
    if depth == len(keys) - 1 and depth:
        found = [field_value(holder[keys[-1].name])]
    step = steps[depth]
    if depth == len(steps) - 1:
        holder[step.name] = found[0]
        return holder
    deeper = lambda x: None if x is None else put(x, steps, keys, field_value, depth + 1, found)
    own = holder[step.name]
    if own is not None:
        holder[step.name] = [deeper(x) for x in own] if step.kind == "[]" else {k: deeper(x) for k, x in own.items()} if step.kind else deeper(own)
    return holder


WRITES = [
    ("a[].NEW", "a[].id"), ("a[].b{}.NEW", "a[].id"), ("a[].b{}.NEW", "a[].b{}.id"), ("a[].b{}.c[].NEW", "a[].b{}.id"), ("a[].b{}.c[].NEW", "a[].id"),
    ("a[].b{}.c[].x", "a[].b{}.c[].id"), ("s.t.u[].NEW", "s.t.id"), ("s.NEW", "s.t"), ("`odd.name`[].w[].`n.ew`", "`odd.name`[].`i.d`"),
]


@pytest.mark.parametrize(("path", "key"), [w for w in WRITES if w[0] != "s.NEW"])
def test_write(docs, path, key):
    top, changed = with_value(path, key, lambda x: F.concat(F.lit("<"), F.coalesce(x, F.lit("none"))))
    got = {r.k: plain(r) for r in docs.withColumn(top, changed).collect()}
    value = lambda x: f"<{'none' if x is None else x}"
    want = {r.k: put(plain(r), parse_path(path), parse_path(key), value) for r in docs.collect()}
    assert got == want


@pytest.mark.parametrize("strategy", ["in_memory", "document_maps", "auto"])
def test_lookups_at_three_levels(spark, docs, strategy):
    names = spark.createDataFrame([("a1", "A"), ("b1", "B"), ("c1", "C"), ("t1", None)], "id string, name string")
    found = {"a1": "A", "b1": "B", "c1": "C"}
    places = [("a[].id", "a[].b{}.ENRICH"), ("a[].b{}.id", "a[].b{}.c[].ENRICH"), ("a[].b{}.c[].id", "a[].b{}.c[].OWN"), ("s.t.id", "s.t.u[].ENRICH")]
    enriched = enrich_paths(docs, [PathDomain(i, o, names, "id", "name", default="?") for i, o in places], strategy)
    assert enriched.columns == docs.columns
    want = {}
    for r in docs.collect():
        doc = plain(r)
        for i, o in places:
            doc = put(doc, parse_path(o), parse_path(i), lambda x: found.get(x, "?"))
        want[r.k] = doc
    assert {r.k: plain(r) for r in enriched.collect()} == want


def test_wrong_paths(spark, docs):
    for path in ("", "a[", "a[]..b", "a[].", "a b"):
        with pytest.raises(ValueError):
            parse_path(path)
    for path, key in (("a[].x", "s.id"), ("a[].x", "a[].b{}.id"), ("k", "k"), ("a[]", "a[].id")):
        with pytest.raises(ValueError):
            with_value(path, key, lambda x: x)
    names = spark.createDataFrame([(1, "A")], "id int, name string")
    with pytest.raises(TypeError):
        enrich_paths(docs, [PathDomain("a[].id", "a[].X", names, "id", "name")])
