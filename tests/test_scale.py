"""What must not grow with the data, or depend on how it is laid out."""

from __future__ import annotations

import os
import shutil
import signal
import time

import pytest
from pyspark.sql import functions as F

import org
from nestweave.operators.lookup import Domain, enrich
from nestweave.operators.spread import HotKeys, assign_piece, row_salt
from nestweave.plans.order_documents import nest_rows
from nestweave.plans.organisation import batch_names, enrich_organisations
from nestweave.plans.queries import QUERIES
from nestweave.sources.reference import reference_by_jdbc
from nestweave.streaming.control import run_to_completion, stop_on_sigterm


def test_one_scan_of_the_reference_serves_three_domains(spark, tmp_path):
    path = str(tmp_path / "reference")
    org.reference(spark).write.parquet(path)
    docs, reference = org.documents(spark), spark.read.parquet(path)
    names = batch_names(docs, reference, ["ord"]).persist()
    plan = names._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    enriched = enrich_organisations(docs, reference, ["ord"], names=names)
    plain = enrich_organisations(docs, org.reference(spark), ["ord"])
    assert enriched.exceptAll(plain).isEmpty() and plain.exceptAll(enriched).isEmpty()
    # What was measured and what is looked up is what was kept: no scan outside of it.
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan
    names.unpersist()


@pytest.mark.parametrize("limit", [0, 200_000])
@pytest.mark.parametrize("strategy", ["auto", "document_maps"])
def test_conflicting_names_are_an_error_at_every_size(spark, monkeypatch, strategy, limit):
    monkeypatch.setattr("nestweave.operators.lookup.IN_MEMORY_ROWS", limit)
    dimension = spark.createDataFrame([("a", "A"), ("b", "B1"), ("b", "B2")], "id string, name string")
    domain = Domain("teams", "teamId", "members", dimension, "id", "name")
    with pytest.raises(ValueError, match="several names for 1 ids"):
        enrich(org.documents(spark), [domain], strategy)


def test_documents_are_bounded_however_keys_recur(spark):
    rows = spark.range(64 * 4096).select((F.col("id") % 64).alias("key"), F.col("id").alias("value"))
    sizes = nest_rows(rows, "key", F.col("value"), "values").select(F.size("values").alias("n"))
    total, longest = sizes.agg(F.sum("n"), F.max("n")).first()
    assert total == 64 * 4096 and longest < 512


def test_unique_keys_are_not_counted_one_by_one(spark):
    rows = spark.range(50_000).select("id")
    assert HotKeys(floor=1000, share=10).find(rows, single=["id"]) == {"id": None}
    hot = HotKeys(floor=1000, share=10).find(rows.withColumn("id", F.when(F.col("id") > 9000, 7).otherwise(F.col("id"))), single=["id"])
    assert hot["id"].count() == 1


def test_pieces_are_more_than_input_partitions(spark):
    rows = spark.range(0, 20_000, 1, 2).select(F.lit(7).alias("key"), F.col("id").alias("value"))
    hot = HotKeys(floor=1000, share=10).find(rows, single=["key"])["key"]
    pieces = assign_piece(rows, hot, "key", row_salt(rows)).groupBy("_piece").count().collect()
    assert len(pieces) == 10 and max(r["count"] for r in pieces) < 3000


class StandIn:
    isActive, stopped = True, False

    def awaitTermination(self):
        os.kill(os.getpid(), signal.SIGTERM)
        time.sleep(5)

    def stop(self):
        self.stopped = True


def test_sigterm_stops_the_query():
    before, query = signal.getsignal(signal.SIGTERM), StandIn()
    try:
        stop_on_sigterm()
        with pytest.raises(SystemExit):
            run_to_completion(query)
    finally:
        signal.signal(signal.SIGTERM, before)
    assert query.stopped


@pytest.mark.parametrize("name", ["stream_ingest", "stream_table_append"])
def test_streams_read_a_folder_of_files(spark, sf_dir, tmp_path, name):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES[name](spark, str(tmp_path))
    assert got.count() == events.count()
    shutil.rmtree(tmp_path / "events.parquet")


def test_many_keys_are_joined_instead_of_sent(spark, monkeypatch):
    class Reader:
        def format(self, _):
            return self

        option = options = lambda self, *a, **k: self

        def load(self):
            return spark.range(5000).withColumnRenamed("id", "key")

    class Session:
        read, createDataFrame = Reader(), spark.createDataFrame

    rows = reference_by_jdbc(Session(), "url", "t", ["key"], key="key", keys=list(range(4000, 6000)))
    assert rows.count() == 1000
