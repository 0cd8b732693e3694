"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Documents are made and stored
before the clock starts; every timed query writes its whole result to Spark's ``noop`` sink or, for
the streams, to files. Each query runs once to warm up and then ``BENCH_RUNS`` times; the best run
counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.operators.dimension import last_wins_dimension
from nestweave.operators.keys import any_domain_match, distinct_keys, key_pruned_reference
from nestweave.operators.lookup import enrich, prune_dimensions
from nestweave.plans import queries as q
from nestweave.plans.order_documents import documents, read_table
from nestweave.session import SETTINGS, shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("nestweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed_queries(spark: SparkSession) -> dict:
    orders = documents(spark, SF_DIR, "orders")
    customers = documents(spark, SF_DIR, "customers")

    q.wide_reference(spark, SF_DIR)

    def lookup(docs, *makers, strategy="auto"):
        return lambda: run(enrich(docs, [m(spark, SF_DIR) for m in makers], strategy))

    def pruned():
        run(enrich(customers, prune_dimensions(customers, [q.order_flag_domain(spark, SF_DIR)])))

    def wide_match():
        keysets = {
            "s_suppkey": read_table(spark, SF_DIR, "supplier").where("s_acctbal < 0"),
            "p_partkey": read_table(spark, SF_DIR, "part").where("p_size = 1"),
            "n_nationkey": read_table(spark, SF_DIR, "nation").where("n_regionkey = 1"),
        }
        run(any_domain_match(q.wide_reference(spark, SF_DIR), keysets))

    def key_pruned():
        keys = distinct_keys(customers, "orders", "orderKey", "l_orderkey")
        run(key_pruned_reference(read_table(spark, SF_DIR, "lineitem"), keys, "l_orderkey"))

    def last_wins():
        lines = read_table(spark, SF_DIR, "lineitem")
        run(last_wins_dimension(lines, "l_orderkey", "l_returnflag", ["l_shipdate"]))

    def stream():
        q._enrich_customers(spark, SF_DIR, shared_folder(spark, "bench"))

    three = (q.supplier_domain, q.part_domain, q.nation_domain)
    return {
        "in_memory_25_keys": lookup(orders, q.nation_domain, strategy="in_memory"),
        "in_memory_suppliers": lookup(orders, q.supplier_domain, strategy="in_memory"),
        "in_memory_parts": lookup(orders, q.part_domain, strategy="in_memory"),
        "document_maps_25_keys": lookup(orders, q.nation_domain, strategy="document_maps"),
        "document_maps_suppliers": lookup(orders, q.supplier_domain, strategy="document_maps"),
        "document_maps_parts": lookup(orders, q.part_domain, strategy="document_maps"),
        "auto_three_domains": lookup(orders, *three),
        "document_maps_three_domains": lookup(orders, *three, strategy="document_maps"),
        "auto_order_flags": lookup(customers, q.order_flag_domain),
        "key_pruned_order_flags": pruned,
        "any_domain_match": wide_match,
        "key_pruned_reference": key_pruned,
        "last_wins_dimension": last_wins,
        "stream_enrich": stream,
    }


def main() -> None:
    spark = session()
    chosen = sys.argv[1:]
    seconds = {}
    for name, query in timed_queries(spark).items():
        if chosen and name not in chosen:
            continue
        query()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            query()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    lines = read_table(spark, SF_DIR, "lineitem").agg(F.count("*")).first()[0]
    result = {
        "metric": "nested enrichment, total of best runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "lineitem_rows": lines,
        "cpus": CPUS,
        "spark": spark.version,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
