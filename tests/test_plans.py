"""What Spark makes of the plans: scans, shuffles and where the lookups run."""

import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from nestweave.operators.keys import any_domain_match, distinct_keys
from nestweave.operators.lookup import Domain, enrich
from nestweave.operators.spread import HotKeys
from nestweave.plans.order_documents import documents, read_table
from nestweave.plans.queries import part_domain, supplier_domain


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return documents(spark, sf_dir, "orders")


@pytest.fixture(scope="module")
def domains(spark, sf_dir):
    return [supplier_domain(spark, sf_dir), part_domain(spark, sf_dir)]


def exchanges_on(plan, attribute):
    return re.findall(rf"hashpartitioning\({attribute}, \d+\)", plan)


@pytest.mark.parametrize("observed", [False, True])
def test_in_memory_does_not_shuffle_documents(orders, domains, observed):
    observation = Observation() if observed else None
    enriched = enrich(orders, domains, "in_memory", observation)
    optimized = enriched._jdf.queryExecution().optimizedPlan().toString()
    # Documents are scanned once; the lookup tables are subqueries inside the expressions, so no
    # operator hands them on as a column.
    assert physical(enriched).count("suppliers") > 0
    assert len(re.findall(r"Relation \[orderKey", optimized)) == 1
    assert "Join" not in optimized
    assert "scalar-subquery" in optimized
    assert "AS _table_" not in optimized


def test_document_maps_read_only_ids_for_the_sets(orders, domains):
    plan = physical(enrich(orders, domains, "document_maps"))
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?ReadSchema: (\S+)", plan)
    schemas = [s for s in scans if "suppKey" in s or "suppliers" in s]
    assert any("lines" not in s for s in schemas), schemas
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_documents_are_shuffled_once(spark, orders, domains):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(enrich(orders, domains, "document_maps"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left, right = re.search(r"SortMergeJoin \[(_id_set#\d+L)\], \[(_id_set#\d+L)\]", plan).groups()
    assert len(exchanges_on(plan, left)) == 1
    # The maps leave their aggregate partitioned for the join: one exchange, below the aggregate.
    assert len(exchanges_on(plan, right)) == 1


def test_disjunction_is_planned_as_equi_joins(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    keys = {
        "l_suppkey": read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey")),
        "l_partkey": read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey")),
    }
    for hot_keys in (HotKeys(), HotKeys(floor=10, share=100)):
        plan = physical(any_domain_match(lines, keys, hot_keys))
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_keys_read_only_the_id_column(orders):
    plan = physical(distinct_keys(orders, "parts", "partKey", "part_key"))
    assert "ReadSchema: struct<parts:array<struct<partKey:bigint>>>" in plan


def test_filters_on_documents_reach_the_scan(orders, domains):
    for strategy in ("in_memory", "document_maps"):
        plan = physical(enrich(orders.where("orderKey = 7"), domains, strategy))
        scans = [x for x in plan.splitlines() if "FileScan" in x and ("orderKey" in x or "suppliers" in x)]
        assert scans and all("EqualTo(orderKey,7)" in x for x in scans)


def test_hot_ids_of_a_third_of_all_rows(spark, orders, domains):
    """A third of the documents are copies of one; the result stays whole and equal."""
    one = orders.where("orderKey = 1").limit(1)
    copies = spark.range(orders.count() // 2).select(F.lit(1).alias("k"))
    repeated = copies.join(one.withColumn("k", F.lit(1)), "k").drop("k").repartition(4)
    skewed = orders.unionByName(repeated)
    cut = enrich(skewed, domains, "document_maps", hot_keys=HotKeys(floor=50, share=100))
    assert "spark_partition_id" in physical(cut).lower()
    plain = enrich(skewed, domains, "in_memory")

    def fingerprint(df):
        rows = df.select(F.xxhash64("orderKey", "suppliers", "parts", "quantities").alias("h"))
        return rows.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()

    assert fingerprint(cut) == fingerprint(plain)


def test_domain_columns_with_dots(spark):
    docs = spark.createDataFrame(
        [(1, [("a", [(1,)])])], "k int, `x.y` array<struct<id: string, items: array<struct<n: int>>>>"
    )
    names = spark.createDataFrame([("a", "A")], "`id.x` string, `name.x` string")
    for strategy in ("in_memory", "document_maps"):
        row = enrich(docs, [Domain("x.y", "id", "items", names, "id.x", "name.x")], strategy).first()
        assert row["x.y"][0]["items"][0].asDict() == {"n": 1, "ENRICH": "A"}
