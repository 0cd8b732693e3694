"""Sketches of ids against exact counts, merged against whole."""

import pytest
from pyspark.sql import functions as F

from nestweave.operators.sketches import SketchLog, dimension_sketches, id_sketches, merged, overlap_estimates, worth_pruning

SCHEMA = "k int, a array<struct<id: long>>, b array<struct<id: long>>"


@pytest.fixture(scope="module")
def docs(spark):
    ids = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.struct(((F.col("id") * 7 + i) % 60000).alias("id")))
    some = spark.range(20000).select(F.col("id").cast("int").alias("k"), ids.alias("a"), F.slice(ids, 1, 2).alias("b"))
    odd = spark.createDataFrame([(-1, None, []), (-2, [(None,)], None), (-3, [], [(None,), (1,)])], SCHEMA)
    return some.unionByName(odd).repartition(6)


FIELDS = {"a": "id", "b": "id"}


def exact(docs, array):
    return docs.select(F.explode(array).alias("x")).select("x.id").where("id IS NOT NULL")


def test_estimates_and_overlap(spark, docs):
    dimension = spark.range(0, 90000, 2).select(F.col("id").alias("key"))
    known = dimension_sketches({"a": (dimension, "key"), "c": (dimension, "key")})
    got = {r.domain: r for r in overlap_estimates(id_sketches(docs, FIELDS), known).collect()}
    for array in "ab":
        rows = exact(docs, array)
        want = rows.distinct().count()
        assert abs(got[array].ids - want) <= 0.03 * want
    both = exact(docs, "a").distinct().where("id % 2 = 0").count()
    assert abs(got["a"].found - both) <= 0.03 * both and abs(got["a"].dimension_ids - 45000) <= 0.03 * 45000
    assert (got["b"].found, got["b"].dimension_ids) == (0, 0)
    assert worth_pruning(overlap_estimates(id_sketches(docs.where("k = 1"), FIELDS), known)) == {"a": True, "b": True}
    assert not worth_pruning(overlap_estimates(id_sketches(docs, {"a": "id"}), known))["a"]


def test_small_sets_are_exact_and_parts_merge_to_the_whole(spark, docs, tmp_path):
    few = docs.where("k BETWEEN -5 AND 300")
    whole = {r.domain: (r.e, r.n) for r in id_sketches(few, FIELDS).select("domain", "n", F.theta_sketch_estimate("sketch").alias("e")).collect()}
    assert whole == {a: (exact(few, a).distinct().count(), exact(few, a).count()) for a in "ab"}
    log = SketchLog(spark, str(tmp_path / "log"), FIELDS)
    for part in (0, 1, 2, 1):  # one batch replayed
        log.record(docs.where(F.pmod("k", F.lit(3)) == part), part)
    estimate = F.theta_sketch_estimate("sketch").alias("e")
    merged_all = {r.domain: (r.e, r.n) for r in log.total().select("domain", "n", estimate).collect()}
    direct = {r.domain: (r.e, r.n) for r in id_sketches(docs, FIELDS).select("domain", "n", estimate).collect()}
    assert {d: n for d, (_, n) in merged_all.items()} == {d: n for d, (_, n) in direct.items()}
    for domain, (value, _) in direct.items():
        assert abs(merged_all[domain][0] - value) <= 0.02 * value
    some = {r.domain: r.n for r in log.total([0]).collect()}
    assert some == {a: exact(docs.where("pmod(k, 3) = 0"), a).count() for a in "ab"}
    assert merged(id_sketches(docs.where("false"), FIELDS)).count() == 0
