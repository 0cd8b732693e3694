"""Reference data that stays: the prefilter, the kept dimension, buckets, replaceable partitions, repair."""

import os
import random
import re
import uuid
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.operators.dimension import chosen_names, last_wins_dimension
from nestweave.operators.keys import any_domain_match, key_pruned_reference
from nestweave.operators.lookup import Domain, enrich
from nestweave.operators.maintained import MaintainedDimension, maintain
from nestweave.operators.metrics import add_digests, digest_columns, digest_of
from nestweave.operators.prefilter import key_bitmap, may_contain, prefilter
from nestweave.plans.order_documents import documents
from nestweave.plans.queries import order_flag_domain
from nestweave.schemas import enriched_schema
from nestweave.sources.partitions import PartitionedFolder
from nestweave.sources.reference import BucketedReference, reference_snapshot, row_uuid
from nestweave.streaming.enrichment import replay_safe_table
from nestweave.streaming.repair import RepairableOutput

BITS = 1 << 15


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


# --- bitmap ---


def test_bitmap_has_every_key_and_few_others(spark):
    keys = spark.range(0, 5000).select((F.col("id") * 3).alias("k"))
    table = key_bitmap(keys, ["k"], 1 << 18).scalar()
    rows = spark.range(0, 30000).select(F.col("id").alias("k")).withColumn("hit", may_contain(table, [F.col("k")], 1 << 18))
    found = {r.k for r in rows.where("hit").collect()}
    wanted = {3 * i for i in range(5000)}
    assert wanted <= found | {k for k in wanted if k >= 30000}
    # 5,000 of 262,144 bits are set.
    assert len(found - wanted) < 0.04 * 25000


def test_bitmap_places_match_the_hash(spark):
    """Every bit on its own: each of the first places of a small bitmap is set by one key and no other."""
    keys = spark.range(0, 300000).select(F.col("id").alias("k"), F.pmod(F.xxhash64("id"), F.lit(BITS)).alias("place"))
    one = keys.groupBy("place").agg(F.min("k").alias("k")).where("place % 97 = 0 OR place < 70 OR place > 32700")
    some = one.where("place % 2 = 0")
    table = key_bitmap(some, ["k"], BITS).scalar()
    got = one.select("place", may_contain(table, [F.col("k")], BITS).alias("hit")).collect()
    assert len(got) > 400 and all(r.hit == (r.place % 2 == 0) for r in got)


def test_prefilter_cases(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, None), (None, None), (5, "a")], "i int, s string")
    ints, texts = spark.createDataFrame([(2,), (None,)], "i int"), spark.createDataFrame([("a",)], "s string")
    got = prefilter(rows, {"i": ints, "s": texts})
    assert sorted(got.collect()) == [(1, "a"), (2, "b"), (5, "a")]
    none = ints.where("i > 99")
    assert prefilter(rows, {"i": none}).count() == 0
    assert prefilter(rows.where("i > 99"), {"i": ints}).count() == 0
    with pytest.raises(ValueError):
        prefilter(rows, {"i": ints}, bits=1000)


def test_prefilter_stands_before_every_exchange(spark, tmp_path):
    """Of 100,000 rows those of 10 keys enter the exchange, and few others."""
    path = str(tmp_path / "reference")
    spark.range(100_000).select((F.col("id") % 1000).alias("k"), F.col("id").cast("string").alias("v")).write.parquet(path)
    reference, keys = spark.read.parquet(path), spark.range(10).select(F.col("id").alias("k"))
    kept = prefilter(reference, {"k": keys})
    assert 1000 <= kept.count() <= 1100
    lines = key_pruned_reference(reference, keys, "k")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "Relation [k" in line)
    assert any(line.lstrip(" :+-").startswith("Filter") and "getbit" in line for line in lines[:scan])
    exact = key_pruned_reference(reference, keys, "k")
    assert exact.count() == 1000 == key_pruned_reference(reference, keys, "k", bits=None).count()
    # A bitmap that is full lets everything pass, and the join is exact all the same.
    many = spark.range(0, 400_000, 2).select(F.col("id").alias("k"))
    assert key_pruned_reference(reference, many, "k", bits=BITS).count() == 50_000
    both = any_domain_match(reference.withColumn("j", F.col("k") + 500), {"k": keys, "j": keys.select(F.col("k").alias("j"))}, bits=BITS)
    assert both.count() == 1000


def test_chosen_names_of_a_hot_id(spark):
    """A third of the reference has one id; what is joined is one row an id, and no row of ids that nobody asks for."""
    rows = [(1 if i % 3 == 0 else i, f"n{i % 50}", i % 7) for i in range(3000)] + [(None, "x", 9), (6, None, 99)]
    reference = spark.createDataFrame(rows, "id long, name string, at int").repartition(8)
    keys = spark.createDataFrame([("d", 1), ("d", 4), ("d", 6), ("d", 77777), ("e", 5)], "domain string, id long")
    for bits in (None, 1 << 23, BITS):
        got = chosen_names(reference, {"d": ("id", "name")}, ["at"], keys, bits)
        want = last_wins_dimension(reference, "id", "name", ["at"]).where("id IN (1, 4, 6)")
        assert sorted(map(tuple, got.select("id", "name").collect())) == sorted(map(tuple, want.collect()))
        # The join finds the rows partitioned by the aggregate: no exchange of the reference above it.
        plan = physical(got)
        assert plan.index("Join") < plan.index("HashAggregate" if "HashAggregate" in plan else "SortAggregate")


def test_chosen_names_combine_without_a_sort(spark):
    """Rows of the reference combine as they are read; ties, null names and several order columns decide as before."""
    rows = [(i % 9, None if i % 4 == 0 else f"n{i % 5}", None if i % 7 == 0 else i % 3, i % 2) for i in range(400)] + [(11, None, None, None)]
    reference = spark.createDataFrame(rows, "id long, name string, at int, then int").repartition(4)
    keys = spark.createDataFrame([("d", i) for i in (0, 3, 8, 11)], "domain string, id long")
    for order in (["at"], ["at", "then"]):
        got = chosen_names(reference, {"d": ("id", "name")}, order, keys)
        want = last_wins_dimension(reference, "id", "name", order).where("id IN (0, 3, 8, 11)")
        assert sorted(map(repr, (tuple(r) for r in got.select("id", "name").collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))
    plan = physical(chosen_names(reference, {"d": ("id", "name")}, ["at"], keys))
    partial = plan[: plan.index("Generate")].rsplit("Exchange", 1)[1]
    assert "HashAggregate" in partial and "SortAggregate" not in partial


# --- partitions and the kept dimension ---


def test_partitions_are_replaced_whole_and_alone(spark, tmp_path):
    folder = PartitionedFolder(spark, str(tmp_path / "p"), "v int, p int", "p")
    assert folder.rows().count() == 0
    frame = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "v int, p int")
    assert folder.replace(frame.where("p IS NOT NULL")) == [0, 1]
    before = files(tmp_path / "p" / "data")
    assert folder.replace(spark.createDataFrame([(9, 1)], "v int, p int")) == [1]
    after = files(tmp_path / "p" / "data")
    assert {f for f in before if "p=0" in f} == {f for f in after if "p=0" in f}
    assert sorted(map(tuple, folder.rows().collect())) == [(1, 0), (2, 0), (9, 1)]
    assert folder.replace(folder.rows(), F.lit(False)) == []
    assert files(tmp_path / "p" / "data") == after


def test_a_crash_before_or_after_the_mark(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    folder = PartitionedFolder(spark, path, "v int, p int", "p")
    folder.replace(spark.createDataFrame([(1, 0), (2, 1)], "v int, p int"))
    new = spark.createDataFrame([(7, 1)], "v int, p int")
    for step, want in (("_mark", [(1, 0), (2, 1)]), ("_apply", [(1, 0), (7, 1)])):
        with monkeypatch.context() as patch:

            def crash(self, *a):
                raise KeyboardInterrupt

            patch.setattr(PartitionedFolder, step, crash)
            with pytest.raises(KeyboardInterrupt):
                PartitionedFolder.replace(folder, new)
        # Who opens it next finishes what was marked.
        assert sorted(map(tuple, PartitionedFolder(spark, path, "v int, p int", "p").rows().collect())) == want


def events(n=600):
    rng = random.Random(8)
    return [(rng.randrange(40) if rng.random() < 0.6 else 7, rng.choice(["a", "b", None, "c"]), rng.randrange(30), rng.choice([None, 1, 2])) for _ in range(n)] + [(None, "x", 1, 1)]


SCHEMA = "id int, name string, ts int, seq int"


def test_kept_dimension_in_any_order(spark, tmp_path):
    rows = events()
    whole = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, last_wins_dimension(whole, "id", "name", ["ts", "seq"]).collect()))
    for n, order in enumerate(([0, 1, 2, 3], [3, 1, 1, 0, 2, 3])):
        path = str(tmp_path / str(n))
        for i in order:  # opened anew for every delta, as a job would
            kept = MaintainedDimension(spark, path, whole, "id", "name", ["ts", "seq"], partitions=8)
            delta = spark.createDataFrame([r for k, r in enumerate(rows) if k % 4 == i], SCHEMA).repartition(3)
            kept.update(delta)
        assert sorted(map(tuple, kept.names().collect())) == want
        assert "Exchange" not in physical(kept.names())
        before = files(path + "/data")
        assert kept.update(delta) == [] and kept.update(delta.where("false")) == []
        assert files(path + "/data") == before


def test_a_delta_touches_its_partitions_only(spark, tmp_path):
    first = spark.createDataFrame([(i, "old", 1, 1) for i in range(200)], SCHEMA)
    kept = MaintainedDimension(spark, str(tmp_path), first, "id", "name", ["ts", "seq"], partitions=16)
    assert len(kept.update(first)) == 16
    before = files(tmp_path / "data")
    written = kept.update(spark.createDataFrame([(5, "new", 2, 1), (6, "late", 0, 1)], SCHEMA))
    assert len(written) == 1  # the name that came late loses, so its partition stays
    changed = files(tmp_path / "data") ^ before
    assert changed and all(f"part={written[0]}" in f for f in changed)
    names = dict(map(tuple, kept.names().collect()))
    assert names[5] == "new" and names[6] == "old" and len(names) == 200


def test_kept_dimension_from_a_stream(spark, tmp_path):
    rows = events(200)
    whole = spark.createDataFrame(rows, SCHEMA)
    whole.repartition(4).write.parquet(str(tmp_path / "in"))
    kept = MaintainedDimension(spark, str(tmp_path / "state"), whole, "id", "name", ["ts", "seq"], partitions=4)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    maintain(stream, kept, str(tmp_path / "checkpoint"), {"availableNow": True}).awaitTermination()
    want = last_wins_dimension(whole, "id", "name", ["ts", "seq"])
    assert sorted(map(tuple, kept.names().collect())) == sorted(map(tuple, want.collect()))


# --- buckets ---


def test_bucketed_reference_does_not_move(spark):
    table = f"reference_{uuid.uuid4().hex}"
    rows = [(i % 60 if i % 3 else 1, f"n{i}", i % 40, f"m{i}", datetime(2024, 1, 1 + i % 28)) for i in range(900)]
    rows += [(None, "x", 3, None, None), (2, None, None, "y", datetime(2025, 1, 1))]
    wide = spark.createDataFrame(rows, "a int, a_name string, b int, b_name string, at timestamp")
    reference = BucketedReference(spark, table, {"a": ("a", "a_name"), "b": ("b", "b_name")}, ["at"], buckets=4)
    reference.append(wide.where("a % 2 = 0 OR a IS NULL"))
    reference.append(wide)  # every bucket has files of both, and rows of the first twice
    keys = spark.createDataFrame([("a", str(i)) for i in range(0, 80, 2)] + [("b", "3"), ("b", "39"), ("c", "1")], "domain string, id string")
    columns = {"a": ("a", "a_name"), "b": ("b", "b_name")}
    text = wide.withColumns({c: F.col(c).cast("string") for c in "ab"})
    want = sorted(map(tuple, chosen_names(text, columns, ["at"], keys).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = reference.names(keys)
        assert sorted(map(tuple, found.collect())) == want
        plan = physical(found).split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1  # that of the keys
    side = plan[: plan.index("Bucketed: true")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in side
    spark.sql(f"DROP TABLE {table}")


# --- repair ---


def org(i, teams):
    return (f"o{i}", None, [(t, None, [(f"m{i}", None, None)]) for t in teams] if teams is not None else None)


def test_repair_reads_and_writes_only_batches_that_miss_a_name(spark, tmp_path):
    kind = T.StructType([f for f in enriched_schema().fields if f.name in ("orgId", "orgName", "teams")])
    raw = "orgId string, orgName string, teams array<struct<teamId: string, teamName: string, members: array<struct<memberId: string, memberName: string, position: string>>>>"
    batches = [[org(0, ["a", "b"])], [org(1, ["a"]), org(2, None), org(3, [])], [org(4, ["c"]), org(5, [None, "b"])], [org(6, ["zz"])]]

    def reference(**names):
        frame = spark.createDataFrame(list(names.items()), "id string, name string").withColumn("domain", F.lit("teams"))
        return lambda keys: frame.join(keys, ["domain", "id"], "left_semi").select("domain", "id", "name")

    def lookup(docs, names):
        return enrich(docs, [Domain("teams", "teamId", "members", names, "id", "name")])

    from nestweave.operators.keys import domain_keys

    def output():
        return RepairableOutput(spark, str(tmp_path / "out"), kind, lambda d: domain_keys(d, {"teams": "teamId"}), lookup)

    out = output()
    for i, rows in enumerate(batches):
        out.write(spark.createDataFrame(rows, raw), i, reference(a="A"))
    out.write(spark.createDataFrame(batches[0], raw), 0, reference(a="A"))  # a replay
    assert sorted(map(tuple, out.missing().collect())) == [("teams", "b"), ("teams", "c"), ("teams", "zz")]
    before = files(tmp_path / "out" / "documents" / "data")
    out = output()
    assert out.repair(reference(a="A")) == []
    assert out.repair(reference(a="A", b="B")) == [0, 2]
    after = files(tmp_path / "out" / "documents" / "data")
    assert {f for f in before if re.search("batch_id=[13]/", f)} <= after
    assert not {f for f in before if re.search("batch_id=[02]/", f)} & after
    full = reference(a="A", b="B", c="C")
    assert out.repair(full) == [2] and out.repair(full) == []
    assert sorted(map(tuple, out.missing().collect())) == [("teams", "zz")]
    every = spark.createDataFrame([r for b in batches for r in b], raw)
    names = full(domain_keys(every, {"teams": "teamId"}))
    key = repr
    assert sorted(map(key, out.rows().collect())) == sorted(map(key, lookup(every, names).collect()))


def test_repair_replaces_batches_together_and_documents_first(spark, tmp_path, monkeypatch):
    from nestweave.operators.keys import domain_keys
    from nestweave.streaming import repair

    monkeypatch.setattr(repair, "TOGETHER", 3)
    raw = "k int, teams array<struct<teamId: string, members: array<struct<n: int>>>>"
    kind = T.StructType.fromDDL("k int, teams array<struct<teamId: string, members: array<struct<n: int, ENRICH: string>>>>")
    frame = lambda b: spark.createDataFrame([(b, [(t, [(b,)]) for t in ("a", f"b{b}")]), (b, None)], raw)

    def reference(*known):
        table = spark.createDataFrame([("teams", k, k.upper()) for k in ("a", *known)], "domain string, id string, name string")
        return lambda keys: table.join(keys, ["domain", "id"], "left_semi")

    def lookup(docs, names):
        return enrich(docs, [Domain("teams", "teamId", "members", names, "id", "name")])

    out = RepairableOutput(spark, str(tmp_path / "out"), kind, lambda d: domain_keys(d, {"teams": "teamId"}), lookup)
    for i in range(5):
        out.write(frame(i), i, reference())
    plain, done = repair.PartitionedFolder.replace, []

    def replace(folder, rows, changed=None):
        done.append(folder.path.rsplit("/", 1)[1])
        if len(done) == 2:
            raise KeyboardInterrupt
        return plain(folder, rows, changed)

    monkeypatch.setattr(repair.PartitionedFolder, "replace", replace)
    names = reference("b0", "b1", "b2", "b3")
    with pytest.raises(KeyboardInterrupt):  # the ledger wasn't written and still names what the documents have got
        out.repair(names)
    assert done == ["documents", "misses"] and out.missing().count() == 5
    assert out.repair(names) == [0, 1, 2, 3]
    assert done[2:] == ["documents", "misses"] * 2
    assert [r.id for r in out.missing().collect()] == ["b4"]
    every = frame(0)
    for i in range(1, 5):
        every = every.unionByName(frame(i))
    want = lookup(every, names(domain_keys(every, {"teams": "teamId"})))
    assert sorted(map(repr, out.rows().collect())) == sorted(map(repr, want.collect()))


def test_a_new_batch_is_written_once_by_several_tasks(spark, tmp_path, monkeypatch):
    from nestweave.operators.keys import domain_keys

    raw = "k int, teams array<struct<teamId: string, members: array<struct<n: int>>>>"
    kind = T.StructType.fromDDL("k int, teams array<struct<teamId: string, members: array<struct<n: int, ENRICH: string>>>>")
    spark.createDataFrame([(i, [("a", [(i,)])]) for i in range(200)], raw).coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = spark.read.schema(raw).parquet(str(tmp_path / "in"))  # one file, which one task reads
    names = spark.createDataFrame([("teams", "a", "A")], "domain string, id string, name string")

    def lookup(docs, names):
        return enrich(docs, [Domain("teams", "teamId", "members", names, "id", "name")])

    out = RepairableOutput(spark, str(tmp_path / "out"), kind, lambda d: domain_keys(d, {"teams": "teamId"}), lookup)
    plain, kinds = PartitionedFolder._write, []

    def write(folder, rows, kind):
        kinds.append((folder.path.rsplit("/", 1)[1], kind))
        plain(folder, rows, kind)

    monkeypatch.setattr(PartitionedFolder, "_write", write)
    out.write(batch, 0, lambda keys: names)
    assert kinds == []  # neither a copy beside the folder nor a mark
    assert len([f for f in files(tmp_path / "out" / "documents" / "data") if f.endswith(".parquet") and "batch_id=0" in f]) > 1
    want = sorted((i, "A") for i in range(200))
    read = lambda o: sorted((r.k, r.teams[0].members[0].ENRICH) for r in o.rows().collect())
    assert read(out) == want
    # A replay finds its batch there and goes the long way, in which a crash leaves no half.
    out.write(batch, 0, lambda keys: names)
    assert ("documents", "pending") in kinds and ("misses", "pending") in kinds and read(out) == want


# --- digests ---


def test_digest_shows_lost_doubled_and_changed_rows(spark):
    rows = [(i, [(f"x{i % 5}", float(i))], None if i % 3 else "s") for i in range(200)]
    schema = "a int, b array<struct<c: string, d: double>>, e string"

    def digest(rows, parts=1):
        frame = spark.createDataFrame(rows, schema).repartition(parts)
        return digest_of(frame.agg(*digest_columns([F.col(c) for c in frame.columns])).first().asDict())

    whole = digest(rows)
    assert digest(rows[::-1], 7) == whole
    assert add_digests([digest(rows[:50]), digest(rows[50:]), digest([])]) == whole
    swapped = [*rows[:10], rows[11], *rows[11:]]  # one lost, another doubled: the count is the same
    changed = [(0, [("x0", 0.5)], "s"), *rows[1:]]
    for other in (rows[1:], [*rows, rows[3]], swapped, changed):
        assert digest(other) != whole
    assert digest(swapped)[0] == whole[0]
    observation = Observation()
    spark.createDataFrame(rows, schema).observe(observation, *digest_columns([F.col(c) for c in "abe"])).count()
    assert digest_of(observation.get) == whole


# --- keys by content ---


def test_row_uuid(spark):
    rows = [(1, "a"), (1, None), (None, "a"), (1, ""), (11, ""), (1, "1:")]
    frame = spark.createDataFrame(rows, "i int, s string")
    keys = [r[0] for r in frame.select(row_uuid([F.col("i"), F.col("s")])).collect()]
    assert len(set(keys)) == len(rows)
    assert all(uuid.UUID(k).version == 8 and uuid.UUID(k).variant == uuid.RFC_4122 and str(uuid.UUID(k)) == k for k in keys)
    snapshot = reference_snapshot([frame, frame.repartition(3)], "key", named=True)
    assert sorted(r.key for r in snapshot.collect()) == sorted(keys) == sorted(r.key for r in snapshot.collect())


# --- computed dimensions, tables ---


def test_a_computed_dimension_is_evaluated_once(spark, sf_dir):
    """The flag of an order is an aggregate over all lines: measured and looked up, they are read in one place."""
    docs = documents(spark, sf_dir, "customers")
    domain = order_flag_domain(spark, sf_dir)
    assert "l_returnflag" in physical(domain.dimension)
    for strategy in ("auto", "document_maps", "in_memory"):
        plan = physical(enrich(docs, [domain], strategy))
        assert "lineitem" not in plan and "dimension-" in plan


def test_table_sink_matches_columns_by_name(spark):
    table = f"sink_{uuid.uuid4().hex}"
    write = replay_safe_table(table)
    write(spark.createDataFrame([(1, "a")], "n int, s string"), 0)
    write(spark.createDataFrame([("b", 2)], "s string, n int"), 1)
    assert Counter(map(tuple, spark.table(table).select("n", "s").collect())) == Counter([(1, "a"), (2, "b")])
    spark.sql(f"DROP TABLE {table}")
