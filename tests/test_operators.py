"""Keys, reference pruning, hot-key joins, conforming and sources on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import org
from nestweave import conform
from nestweave.operators.keys import (
    any_domain_match,
    distinct_keys,
    exploded_keys,
    key_pruned_reference,
    nested_keys,
)
from nestweave.operators.spread import HotKeys, hot_table, spread_join
from nestweave.plans.order_documents import nest_rows
from nestweave.sources.documents import admission_options
from nestweave.sources.reference import reference_by_jdbc, reference_snapshot

CUT = HotKeys(floor=5, share=50)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_keys_of_documents(spark):
    docs = org.documents(spark)
    per_document = nested_keys(docs, "teams", "teamId", "ids").collect()
    assert len(per_document) == len(org.DOCUMENTS)
    assert ["TEAM_DESIGN_1", "TEAM_AI_RESEARCH_6"] in [r.ids for r in per_document]
    every = [r.id for r in exploded_keys(docs, "teams", "teamId", "id").collect()]
    assert len(every) == 11 and every.count(None) == 2
    distinct = [r.id for r in distinct_keys(docs, "teams", "teamId", "id").collect()]
    assert sorted(distinct) == sorted(set(every) - {None})


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows of which a third have one key and a sixth have none; 40 keys in all."""
    rng = random.Random(7)
    keys = ["hot"] * 100 + [None] * 50 + [f"k{rng.randrange(60)}" for _ in range(150)]
    rows = [(k, i) for i, k in enumerate(keys)]
    left = spark.createDataFrame(rows, "key string, n int").repartition(6)
    names = [("hot", "Hot")] + [(f"k{i}", f"K{i}") for i in range(40)]
    return left, spark.createDataFrame(names, "key string, name string"), rows, dict(names)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("hot_keys", [CUT, HotKeys()])
def test_spread_join_equals_a_plain_join(skewed, how, hot_keys):
    left, right, rows, names = skewed
    got = spread_join(left, right, "key", how, hot_keys).collect()
    if how == "left_semi":
        want = [(k, n) for k, n in rows if k in names]
    else:
        want = [(k, n, names.get(k)) for k, n in rows if how == "left" or k in names]
    assert sorted(map(tuple, got), key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])


def test_hot_keys_are_few_and_cut_into_pieces(spark, skewed):
    left, *_ = skewed
    found = CUT.find(left, ["n", "key"])
    assert found["n"] is None
    pieces = [r[1] for r in found["key"].collect()]
    assert max(pieces) == 9  # 100 of 600 values, in pieces of a fiftieth: 12
    assert len(pieces) <= CUT.share and sum(pieces) <= 2 * CUT.share
    assert HotKeys().find(left, ["n", "key"]) == {"n": None, "key": None}
    arrays = left.select("n", F.array("key").alias("key"))
    again = CUT.find(arrays, ["n"], ["key"])["key"].collect()
    assert sorted(again) == sorted(found["key"].collect())
    assert hot_table(spark, []) is None


def test_key_pruned_reference(skewed):
    left, right, rows, names = skewed
    got = key_pruned_reference(left, right, "key", CUT).collect()
    assert sorted(r.n for r in got) == sorted(n for k, n in rows if k in names)


@pytest.mark.parametrize("hot_keys", [CUT, HotKeys()])
def test_any_domain_match(spark, hot_keys):
    reference = org.reference(spark)
    keysets = {
        "teamId": spark.createDataFrame([("TEAM_O'BRIEN",)], "teamId string"),
        "projectId": spark.createDataFrame([("PRJ_MOBILE_APP_6",), ("P",)], "projectId string"),
        "deptId": spark.createDataFrame([("DEPT_AI_RESEARCH_3",)], "deptId string"),
    }
    got = any_domain_match(reference, keysets, hot_keys)
    assert got.columns == reference.columns
    assert sorted(r.ord for r in got.collect()) == [0, 3, 4]
    nothing = {"teamId": spark.createDataFrame([], "teamId string")}
    assert any_domain_match(reference, nothing).collect() == []


def test_nest_rows_cuts_long_documents(spark):
    rows = [("long", i) for i in range(100)] + [(f"k{i % 20}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, n int")
    for hot_keys in (CUT, HotKeys()):
        docs = nest_rows(df, "key", F.struct("n"), "items", 10, hot_keys).collect()
        assert max(len(d["items"]) for d in docs) <= 30
        assert sum(d["key"] == "long" for d in docs) == 10
        assert sorted((d["key"], x.n) for d in docs for x in d["items"]) == sorted(rows)


def test_conform_goes_by_name(spark):
    have = "a int, b array<struct<x: int, y: string, z: array<struct<p: int, q: int>>>>, c string"
    rows = [
        (1, [(1, "u", [(1, 2)]), None, (2, None, None)], "drop"),
        (2, None, None),
        (3, [], None),
    ]
    want = T.StructType.fromDDL(
        "b array<struct<z: array<struct<q: bigint, p: int>>, x: bigint>>, a int"
    )
    got = conform(spark.createDataFrame(rows, have), want)
    assert got.schema.simpleString() == want.simpleString()
    by_a = {r.a: r.b for r in got.collect()}
    assert by_a[1][0].asDict(True) == {"z": [{"q": 2, "p": 1}], "x": 1}
    assert by_a[1][1] is None
    assert by_a[1][2].asDict(True) == {"z": None, "x": 2}
    assert by_a[2] is None and by_a[3] == []


def test_conform_names_what_is_missing(spark):
    df = spark.createDataFrame([(1, [(1,)])], "a int, b array<struct<x: int>>")
    with pytest.raises(ValueError, match="column c"):
        conform(df, T.StructType.fromDDL("c int"))
    with pytest.raises(ValueError, match=r"field b\[\]\.y"):
        conform(df, T.StructType.fromDDL("b array<struct<y: int>>"))


def test_conform_leaves_fitting_columns_alone(spark):
    docs = org.documents(spark)
    plan = conform(docs, docs.schema)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in plan


def test_reference_snapshot(spark):
    reference = org.reference(spark)
    parts = [reference.where("ord < 3"), reference.where("ord > 1"), reference.limit(2)]
    assert rows_of(reference_snapshot(parts)) == rows_of(reference)
    keyed = reference_snapshot(parts, surrogate_key="id")
    assert keyed.columns == ["id", *reference.columns]
    assert len({r.id for r in keyed.collect()}) == len(org.REFERENCE)


def test_admission_options():
    assert admission_options() == {}
    assert admission_options(max_files=1) == {"maxFilesPerTrigger": "1"}
    assert admission_options(max_bytes=485760) == {"maxBytesPerTrigger": "485760"}
    with pytest.raises(ValueError, match="not both"):
        admission_options(1, 1)


class FakeSession:
    """Stands in for the database side of a JDBC read: notes the options, returns given rows."""

    def __init__(self, rows):
        self.rows, self.settings, self.read = rows, {}, self

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **options):
        self.settings.update(options)
        return self

    def load(self):
        return self.rows


def test_jdbc_reader_options(spark):
    session = FakeSession(org.reference(spark))
    got = reference_by_jdbc(
        session, "jdbc:x", "ref", ["teamId", "teamName"], "teamId", ["TEAM_O'BRIEN"],
        partition_column="ord", lower_bound=0, upper_bound=5, num_partitions=2, driver="d",
    )
    assert [tuple(r) for r in got.collect()] == [("TEAM_O'BRIEN", "O'Brien's Team")]
    assert session.settings == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "ref",
        "fetchsize": "100000",
        "partitionColumn": "ord",
        "lowerBound": "0",
        "upperBound": "5",
        "numPartitions": "2",
        "driver": "d",
    }
    with pytest.raises(ValueError, match="lower_bound"):
        reference_by_jdbc(session, "jdbc:x", "ref", ["teamId"], partition_column="ord")
    with pytest.raises(ValueError, match="name of their column"):
        reference_by_jdbc(session, "jdbc:x", "ref", ["teamId"], keys=["k"])
