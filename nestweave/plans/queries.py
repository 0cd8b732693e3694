"""Every operator as a query over the order tables, with the SQL it must agree with.

``@query(sql)`` registers a function of (session, folder of the tables). Results are flattened to
scalars, so they compare without regard to the order of rows or array elements.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from threading import Event

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestweave.operators.conform import conform
from nestweave.operators.dimension import (
    buckets_for,
    chosen_names,
    last_wins_dimension,
    lookup_buckets,
)
from nestweave.operators.keys import (
    any_domain_match,
    distinct_keys,
    domain_keys,
    exploded_keys,
    key_pruned_reference,
    nested_keys,
)
from nestweave.operators.lookup import Domain, enrich, lookup_sizes, prune_dimensions
from nestweave.operators.maintained import MaintainedDimension
from nestweave.operators.path_lookup import PathDomain, enrich_paths
from nestweave.operators.metrics import add_digests, digest_of, row_count
from nestweave.operators.sketches import SketchLog, dimension_sketches, overlap_estimates
from nestweave.operators.spread import spread_join
from nestweave.plans.order_documents import (
    documents,
    documents_folder,
    flatten_documents,
    read_table,
)
from nestweave.schemas import create_document_table, with_inner_field
from nestweave.session import shared_folder
from nestweave.sources.documents import folder_stream, nested_file_stream, table_stream
from nestweave.sources.reference import BucketedReference, reference_snapshot
from nestweave.streaming.control import ProgressLog, run_to_completion, trigger_policy
from nestweave.streaming.enrichment import (
    BATCH,
    Sink,
    append_to_table,
    enrich_stream,
    replay_safe_folder,
    replay_safe_table,
)
from nestweave.streaming.ingest import append_stream_to_folder, append_stream_to_table
from nestweave.streaming.reconcile import DigestLog, digested, digested_as
from nestweave.streaming.repair import RepairableOutput

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


# --- domains over the test tables -------------------------------------------------------------


def supplier_domain(spark: SparkSession, sf_dir: str, **changes) -> Domain:
    suppliers = read_table(spark, sf_dir, "supplier")
    return Domain("suppliers", "suppKey", "lines", suppliers, "s_suppkey", "s_name", **changes)


def part_domain(spark: SparkSession, sf_dir: str, **changes) -> Domain:
    parts = read_table(spark, sf_dir, "part")
    return Domain("parts", "partKey", "lines", parts, "p_partkey", "p_name", **changes)


def nation_domain(spark: SparkSession, sf_dir: str, **changes) -> Domain:
    nations = read_table(spark, sf_dir, "nation")
    return Domain("nations", "nationKey", "lines", nations, "n_nationkey", "n_name", **changes)


def order_flag_domain(spark: SparkSession, sf_dir: str, **changes) -> Domain:
    """The return flag of the line of an order that was shipped last; some orders have no line."""
    flags = last_wins_dimension(
        read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", ["l_shipdate"]
    )
    return Domain("orders", "orderKey", "entries", flags, "l_orderkey", "l_returnflag", computed=True, **changes)


def order_lines(docs: DataFrame, array: str, id_field: str) -> DataFrame:
    item = F.col("item")
    return flatten_documents(
        docs,
        "orderKey",
        array,
        id_field,
        "lines",
        item["lineNumber"].alias("line_number"),
        item["quantity"].alias("quantity"),
        item["ENRICH"].alias("enrich"),
    ).withColumnRenamed("orderKey", "order_key")


def customer_orders(docs: DataFrame) -> DataFrame:
    item = F.col("item")
    return flatten_documents(
        docs,
        "custKey",
        "orders",
        "orderKey",
        "entries",
        item["status"].alias("status"),
        item["ENRICH"].alias("enrich"),
    ).withColumnRenamed("custKey", "cust_key")


SUPPLIER_SQL = """
SELECT l_orderkey AS order_key, l_suppkey AS id, l_linenumber AS line_number,
       l_quantity AS quantity, coalesce(s_name, 'NOT_FOUND') AS enrich
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
"""

PART_SQL = """
SELECT l_orderkey AS order_key, l_partkey AS id, l_linenumber AS line_number,
       l_quantity AS quantity, coalesce(p_name, 'NOT_FOUND') AS enrich
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""

NATION_SQL = """
SELECT l_orderkey AS order_key, s_nationkey AS id, l_linenumber AS line_number,
       l_quantity AS quantity, coalesce(n_name, 'NOT_FOUND') AS enrich
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
"""

LAST_FLAG_SQL = """
SELECT l_orderkey, l_returnflag FROM (
    SELECT l_orderkey, l_returnflag, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_returnflag DESC) AS rn
    FROM lineitem) WHERE rn = 1
"""

ORDER_FLAG_SQL = f"""
SELECT o_custkey AS cust_key, o_orderkey AS id, o_orderstatus AS status,
       coalesce(l_returnflag, 'NOT_FOUND') AS enrich
FROM orders LEFT JOIN ({LAST_FLAG_SQL}) ON o_orderkey = l_orderkey
"""


# --- lookups ----------------------------------------------------------------------------------


@query(SUPPLIER_SQL)
def nested_lookup_supplier(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, [supplier_domain(spark, sf_dir)], "document_maps")
    return order_lines(enriched, "suppliers", "suppKey")


@query(PART_SQL)
def nested_lookup_part(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, [part_domain(spark, sf_dir)], "document_maps")
    return order_lines(enriched, "parts", "partKey")


@query(NATION_SQL)
def nested_lookup_nation(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, [nation_domain(spark, sf_dir)])
    return order_lines(enriched, "nations", "nationKey")


@query(NATION_SQL)
def nested_lookup_broadcast_map(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, [nation_domain(spark, sf_dir)], "in_memory")
    return order_lines(enriched, "nations", "nationKey")


@query(ORDER_FLAG_SQL)
def nested_lookup_order_flag(spark, sf_dir):
    """Some orders have no lines: these are the misses."""
    docs = documents(spark, sf_dir, "customers")
    return customer_orders(enrich(docs, [order_flag_domain(spark, sf_dir)], "document_maps"))


@query(ORDER_FLAG_SQL)
def nested_lookup_order_flag_auto(spark, sf_dir):
    """In memory or by document maps, as the dimension is measured to be."""
    docs = documents(spark, sf_dir, "customers")
    return customer_orders(enrich(docs, [order_flag_domain(spark, sf_dir)]))


@query(ORDER_FLAG_SQL)
def nested_lookup_key_pruned(spark, sf_dir):
    """The dimension is first cut to the ids the documents use."""
    docs = documents(spark, sf_dir, "customers")
    domains = prune_dimensions(docs, [order_flag_domain(spark, sf_dir)])
    return customer_orders(enrich(docs, domains))


@query(ORDER_FLAG_SQL.replace("NOT_FOUND", "no lines"))
def nested_lookup_default(spark, sf_dir):
    docs = documents(spark, sf_dir, "customers")
    domain = order_flag_domain(spark, sf_dir, default="no lines")
    return customer_orders(enrich(docs, [domain]))


@query(PART_SQL)
def nested_lookup_struct_enrich(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    domain = part_domain(spark, sf_dir, struct_field="PARTNAME")
    rows = order_lines(enrich(docs, [domain]), "parts", "partKey")
    return rows.withColumn("enrich", F.col("enrich.PARTNAME"))


ALL_DOMAINS_SQL = f"""
SELECT 'suppliers' AS domain, * FROM ({SUPPLIER_SQL})
UNION ALL SELECT 'parts' AS domain, * FROM ({PART_SQL})
UNION ALL SELECT 'nations' AS domain, * FROM ({NATION_SQL})
"""


def _all_arrays(enriched: DataFrame) -> DataFrame:
    arrays = {"suppliers": "suppKey", "parts": "partKey", "nations": "nationKey"}
    rows = [
        order_lines(enriched, array, id_field).select(F.lit(array).alias("domain"), "*")
        for array, id_field in arrays.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _order_domains(spark: SparkSession, sf_dir: str) -> list[Domain]:
    domains = (supplier_domain, part_domain, nation_domain)
    return [domain(spark, sf_dir) for domain in domains]


@query(ALL_DOMAINS_SQL)
def nested_lookup_all_domains(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    return _all_arrays(enrich(docs, _order_domains(spark, sf_dir)))


@query(ALL_DOMAINS_SQL)
def nested_lookup_all_domains_document_maps(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    return _all_arrays(enrich(docs, _order_domains(spark, sf_dir), "document_maps"))


LAST_EVENT_SQL = """
SELECT user_id, event_type FROM (
    SELECT user_id, event_type, row_number() OVER (
        PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) AS rn
    FROM events) WHERE rn = 1
"""


def _last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return last_wins_dimension(events, "user_id", "event_type", ["ts", "event_id"])


@query(
    f"""
SELECT 'suppliers' AS domain, * FROM ({SUPPLIER_SQL})
UNION ALL SELECT 'parts' AS domain, l_orderkey, l_partkey, l_linenumber, l_quantity,
    coalesce(event_type, 'NOT_FOUND') FROM lineitem LEFT JOIN ({LAST_EVENT_SQL}) ON l_partkey = user_id
UNION ALL SELECT 'nations' AS domain, * FROM ({NATION_SQL})
"""
)
def nested_lookup_domains_with_misses(spark, sf_dir):
    """Three domains of which one misses: there are fewer users with events than parts."""
    docs = documents(spark, sf_dir, "orders")
    events = Domain("parts", "partKey", "lines", _last_events(spark, sf_dir), "user_id", "event_type")
    domains = [supplier_domain(spark, sf_dir), events, nation_domain(spark, sf_dir)]
    return _all_arrays(enrich(docs, domains, "document_maps"))


@query(ALL_DOMAINS_SQL)
def nested_lookup_wide_reference(spark, sf_dir):
    """Names of three domains, cut and chosen together from the wide reference, then looked up."""
    docs = documents(spark, sf_dir, "orders")
    wide = wide_reference(spark, sf_dir).withColumn("n_nationkey", F.col("n_nationkey").cast("long"))
    names = chosen_names(wide, _WIDE_DOMAINS, ["l_shipdate"], domain_keys(docs, _ORDER_IDS, "bigint"))
    return _all_arrays(_with_names(docs, names))


_ORDER_IDS = {"suppliers": "suppKey", "parts": "partKey", "nations": "nationKey"}
_WIDE_DOMAINS = {
    "suppliers": ("s_suppkey", "s_name"),
    "parts": ("p_partkey", "p_name"),
    "nations": ("n_nationkey", "n_name"),
}


def _with_names(docs: DataFrame, names: DataFrame, arrays: Sequence[str] = tuple(_ORDER_IDS)) -> DataFrame:
    """Order documents with ``names`` (domain, id, name), which are written once, looked up."""
    folder = shared_folder(docs.sparkSession, "names")
    names.write.parquet(folder)
    return _looked_up(docs, docs.sparkSession.read.schema(names.schema).parquet(folder), arrays)


def _looked_up(docs: DataFrame, names: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Order documents with ``names`` (domain, id, name), which are a table, looked up."""

    def domain(array: str) -> Domain:
        id_field = _ORDER_IDS[array]
        id_type = docs.schema[array].dataType.elementType[id_field].dataType
        own = names.where(F.col("domain") == array)
        own = own.select(F.col("id").cast(id_type).alias("id"), "name")
        return Domain(array, id_field, "lines", own, "id", "name")

    return enrich(docs, [domain(array) for array in arrays])


def _deep_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents one level deeper: an array of structs, in them suppliers and parts as maps, in those arrays."""

    def by_key(array: str, id_field: str):
        entries = F.transform(array, lambda x: F.struct(x[id_field].cast("string").alias("key"), x.alias("value")))
        return F.map_from_entries(F.filter(entries, lambda x: x["key"].isNotNull())).alias(array)

    docs = documents(spark, sf_dir, "orders")
    group = F.struct(F.lit("order").alias("kind"), by_key("suppliers", "suppKey"), by_key("parts", "partKey"))
    return docs.select("orderKey", F.array(group).alias("groups"))


@query(
    f"""
SELECT 'suppliers' AS domain, * FROM ({SUPPLIER_SQL})
UNION ALL SELECT 'parts' AS domain, * FROM ({PART_SQL})
"""
)
def nested_lookup_any_depth(spark, sf_dir):
    """Ids inside maps inside an array, written into the arrays that the maps hold."""
    domains = [
        PathDomain("groups[].suppliers{}.suppKey", "groups[].suppliers{}.lines[].ENRICH", read_table(spark, sf_dir, "supplier"), "s_suppkey", "s_name"),
        PathDomain("groups[].parts{}.partKey", "groups[].parts{}.lines[].ENRICH", read_table(spark, sf_dir, "part"), "p_partkey", "p_name"),
    ]
    found = enrich_paths(_deep_documents(spark, sf_dir), domains, "document_maps")
    groups = found.select("orderKey", F.explode("groups").alias("g"))
    arrays = {
        array: groups.select("orderKey", F.map_values(F.col("g")[array]).alias(array)) for array in ("suppliers", "parts")
    }
    rows = [
        order_lines(arrays["suppliers"], "suppliers", "suppKey").withColumn("domain", F.lit("suppliers")),
        order_lines(arrays["parts"], "parts", "partKey").withColumn("domain", F.lit("parts")),
    ]
    return reduce(DataFrame.unionByName, rows)


@query(ALL_DOMAINS_SQL)
def nested_lookup_bucketed_reference(spark, sf_dir):
    """Names from a table bucketed by id, to which the wide reference was appended in two parts."""
    docs = documents(spark, sf_dir, "orders")
    table = shared_folder(spark, "bucketed_reference").rsplit("/", 1)[1].replace("-", "_")
    reference = BucketedReference(spark, table, _WIDE_DOMAINS, ["l_shipdate"], buckets=16, id_type="bigint")
    wide = wide_reference(spark, sf_dir)
    early = F.pmod(F.xxhash64("l_shipdate", "p_partkey"), F.lit(2)) == 0
    reference.append(wide.where(early))
    reference.append(wide.where(~early))
    return _all_arrays(_with_names(docs, reference.names(domain_keys(docs, _ORDER_IDS, "bigint"))))


# --- keys and reference -----------------------------------------------------------------------


@query(
    """
SELECT count(*) AS n_ids, min(o_orderkey) AS least_id, max(o_orderkey) AS greatest_id FROM orders
"""
)
def nested_keys_of_documents(spark, sf_dir):
    """The ids of every document as an array, summed up over the documents."""
    keys = nested_keys(documents(spark, sf_dir, "customers"), "orders", "orderKey", "ids")
    return keys.agg(
        F.sum(F.size("ids")).alias("n_ids"),
        F.min(F.array_min("ids")).alias("least_id"),
        F.max(F.array_max("ids")).alias("greatest_id"),
    )


@query("SELECT o_orderkey AS order_key FROM orders")
def nested_keys_exploded(spark, sf_dir):
    return exploded_keys(documents(spark, sf_dir, "customers"), "orders", "orderKey", "order_key")


@query("SELECT DISTINCT l_suppkey AS supp_key FROM lineitem")
def distinct_key_set(spark, sf_dir):
    return distinct_keys(documents(spark, sf_dir, "orders"), "suppliers", "suppKey", "supp_key")


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
"""
)
def key_pruned_orders(spark, sf_dir):
    keys = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return key_pruned_reference(orders, keys.distinct(), "o_orderkey")


WIDE_SQL = """
SELECT s_suppkey, s_name, p_partkey, p_name, n_nationkey, n_name, l_shipdate
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN nation ON s_nationkey = n_nationkey
"""


def wide_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "reference")


@query(
    f"""
SELECT * FROM ({WIDE_SQL})
WHERE s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
   OR p_partkey IN (SELECT p_partkey FROM part WHERE p_size = 1)
   OR n_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
                      WHERE r_regionkey = 1)
"""
)
def any_domain_match_wide(spark, sf_dir):
    keysets = {
        "s_suppkey": read_table(spark, sf_dir, "supplier").where("s_acctbal < 0"),
        "p_partkey": read_table(spark, sf_dir, "part").where("p_size = 1"),
        "n_nationkey": read_table(spark, sf_dir, "nation").where("n_regionkey = 1"),
    }
    return any_domain_match(wide_reference(spark, sf_dir), keysets)


@query(LAST_EVENT_SQL)
def last_wins_dimension_events(spark, sf_dir):
    return _last_events(spark, sf_dir)


@query(LAST_EVENT_SQL)
def last_wins_dimension_incremental(spark, sf_dir):
    """The same from a kept dimension, to which events came in five parts, out of order and one of them twice."""
    events = read_table(spark, sf_dir, "events")
    kept = MaintainedDimension(
        spark, shared_folder(spark, "last-events"), events, "user_id", "event_type", ["ts", "event_id"], partitions=16
    )
    for part in (3, 0, 4, 0, 1, 2):
        kept.update(events.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == part))
    return kept.names()


@query(
    f"""
SELECT 'supplier' AS domain, s_suppkey AS id, any_value(s_name) AS name FROM ({WIDE_SQL}) GROUP BY 2
UNION ALL
SELECT 'part' AS domain, p_partkey AS id, any_value(p_name) AS name FROM ({WIDE_SQL}) GROUP BY 2
UNION ALL
SELECT 'nation' AS domain, n_nationkey AS id, any_value(n_name) AS name FROM ({WIDE_SQL}) GROUP BY 2
"""
)
def dimensions_from_wide(spark, sf_dir):
    """One clean dimension per domain, cut from the wide reference."""
    wide = wide_reference(spark, sf_dir)
    pairs = {
        "supplier": ("s_suppkey", "s_name"),
        "part": ("p_partkey", "p_name"),
        "nation": ("n_nationkey", "n_name"),
    }
    cut = [
        last_wins_dimension(wide, id_column, name, ["l_shipdate"]).select(
            F.lit(domain).alias("domain"),
            F.col(id_column).cast("long").alias("id"),
            F.col(name).alias("name"),
        )
        for domain, (id_column, name) in pairs.items()
    ]
    return reduce(DataFrame.unionByName, cut)


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def lookup_map_entries(spark, sf_dir):
    """The maps of a dimension, one per hash bucket, unfolded again."""
    part = read_table(spark, sf_dir, "part")
    buckets = buckets_for(part.count())
    table = lookup_buckets(part, "p_partkey", "p_name", buckets)
    maps = table.select(F.map_from_entries("entries").alias("names"))
    return maps.select(F.explode("names").alias("id", "name"))


@query(
    """
SELECT DISTINCT * FROM (
    SELECT s_suppkey, s_name, s_nationkey FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_acctbal > 0
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier JOIN lineitem ON s_suppkey = l_suppkey)
"""
)
def reference_union_dedup(spark, sf_dir):
    """Three parts that overlap: all suppliers, those in credit, and one row per line delivered."""
    suppliers = read_table(spark, sf_dir, "supplier")
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"))
    delivered = spread_join(lines, suppliers, "s_suppkey", "inner")
    parts = [suppliers, suppliers.where("s_acctbal > 0"), delivered]
    return reference_snapshot([p.select("s_suppkey", "s_name", "s_nationkey") for p in parts])


@query("SELECT count(*) AS n_rows, count(*) AS n_keys FROM (SELECT DISTINCT * FROM orders)")
def reference_surrogate_key(spark, sf_dir):
    keyed = reference_snapshot([read_table(spark, sf_dir, "orders")], surrogate_key="row_id")
    return keyed.agg(
        F.count("*").alias("n_rows"), F.count_distinct("row_id").alias("n_keys")
    )


@query(
    """
SELECT s_suppkey, s_name, s_nationkey, concat_ws('-', substr(d, 1, 8), substr(d, 9, 4), '8' || substr(d, 14, 3),
    substr('89ab', (strpos('0123456789abcdef', substr(d, 17, 1)) - 1) % 4 + 1, 1) || substr(d, 18, 3),
    substr(d, 21, 12)) AS row_id
FROM (SELECT DISTINCT s_suppkey, s_name, s_nationkey, sha256(concat_ws(',',
    length(s_suppkey::VARCHAR) || ':' || s_suppkey, length(s_name) || ':' || s_name,
    length(s_nationkey::VARCHAR) || ':' || s_nationkey)) AS d
    FROM supplier JOIN lineitem ON s_suppkey = l_suppkey)
"""
)
def reference_named_key(spark, sf_dir):
    """Keys that a row has by its content: the snapshot of two overlapping parts gives the same ones again."""
    suppliers = read_table(spark, sf_dir, "supplier")
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"))
    delivered = spread_join(lines, suppliers, "s_suppkey", "inner").select("s_suppkey", "s_name", "s_nationkey")
    return reference_snapshot([delivered, delivered], surrogate_key="row_id", named=True)


# --- shape ------------------------------------------------------------------------------------

CONFORMED_ORDERS = """
    suppliers ARRAY<STRUCT<suppKey: BIGINT, lines: ARRAY<STRUCT<
        ENRICH: STRING, quantity: DOUBLE, lineNumber: BIGINT>>>>,
    orderKey STRING
"""


@query(
    f"""
SELECT CAST(order_key AS VARCHAR) AS order_key, id, CAST(line_number AS BIGINT) AS line_number,
       quantity, enrich FROM ({SUPPLIER_SQL})
"""
)
def conformed_output(spark, sf_dir):
    """Fields picked and reordered by name at every level, types cast, other columns dropped."""
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, [supplier_domain(spark, sf_dir)])
    return order_lines(conform(enriched, T.StructType.fromDDL(CONFORMED_ORDERS)), "suppliers", "suppKey")


@query("SELECT l_orderkey AS order_key, l_quantity AS quantity FROM lineitem")
def passthrough_array(spark, sf_dir):
    docs = documents(spark, sf_dir, "orders")
    enriched = enrich(docs, _order_domains(spark, sf_dir))
    return enriched.select(
        F.col("orderKey").alias("order_key"), F.explode("quantities").alias("quantity")
    )


@query(SUPPLIER_SQL)
def document_table_round_trip(spark, sf_dir):
    """Enriched documents written to a declared nested table and read back from it."""
    docs = documents(spark, sf_dir, "orders").select("orderKey", "suppliers")
    schema = with_inner_field(
        docs.schema, "suppliers", "lines", T.StructField("ENRICH", T.StringType())
    )
    folder = shared_folder(spark, "table")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    create_document_table(spark, table, schema, folder)
    append_to_table(table)(enrich(docs, [supplier_domain(spark, sf_dir)]), 0)
    return order_lines(spark.table(table), "suppliers", "suppKey")


# --- counts -----------------------------------------------------------------------------------

METRICS = ["orders_elements", "orders_hits", "orders_misses"]


def _metrics_table(spark: SparkSession, batches: list[dict]) -> DataFrame:
    rows = [tuple(m[n] for n in METRICS) for m in batches]
    table = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in METRICS))
    return table.agg(*[F.sum(n).alias(n) for n in METRICS])


METRICS_SQL = f"""
SELECT count(*) AS orders_elements,
       count(*) FILTER (WHERE enrich <> 'NOT_FOUND') AS orders_hits,
       count(*) FILTER (WHERE enrich = 'NOT_FOUND') AS orders_misses
FROM ({ORDER_FLAG_SQL})
"""


@query(METRICS_SQL)
def enrichment_metrics(spark, sf_dir):
    """Counts that ride along with the write of the result."""
    docs = documents(spark, sf_dir, "customers")
    observation = Observation()
    enriched = enrich(docs, [order_flag_domain(spark, sf_dir)], observation=observation)
    enriched.write.format("noop").mode("overwrite").save()
    return _metrics_table(spark, [observation.get])


@query(
    """
SELECT 'orders' AS domain, count(DISTINCT o_orderkey) AS ids,
       count(DISTINCT l_orderkey) AS found
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
"""
)
def dimension_lookup_sizes(spark, sf_dir):
    docs = documents(spark, sf_dir, "customers")
    return lookup_sizes(docs, [order_flag_domain(spark, sf_dir)])


@query(
    """
SELECT 'orders' AS domain, count(DISTINCT o_orderkey) AS ids, count(DISTINCT l_orderkey) AS found,
       TRUE AS ids_within, TRUE AS found_within
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
"""
)
def dimension_overlap_estimates(spark, sf_dir):
    """Sketches of four batches, stored and merged: within 3 % of the exact numbers, which stand beside."""
    docs = documents(spark, sf_dir, "customers")
    domain = order_flag_domain(spark, sf_dir).stored()
    log = SketchLog(spark, shared_folder(spark, "sketches"), {"orders": "orderKey"})
    for part in range(4):
        log.record(docs.where(F.pmod(F.xxhash64("custKey"), F.lit(4)) == part), part)
    known = dimension_sketches({"orders": (domain.dimension, "l_orderkey")})
    estimates = overlap_estimates(log.total(), known).select("domain", F.col("ids").alias("about"), F.col("found").alias("about_found"))
    exact = lookup_sizes(docs, [domain]).join(estimates, "domain")
    return exact.select(
        "domain", "ids", "found",
        (F.abs(F.col("about") - F.col("ids")) <= F.col("ids") * 0.03).alias("ids_within"),
        (F.abs(F.col("about_found") - F.col("found")) <= F.col("found") * 0.03).alias("found_within"),
    )


@query("SELECT count(*) AS n_rows FROM lineitem")
def row_counts(spark, sf_dir):
    return row_count(read_table(spark, sf_dir, "lineitem"))


@query("SELECT least(count(*), 10) AS n_rows FROM lineitem")
def sample_limit(spark, sf_dir):
    """An unordered sample of ten rows; only their number is defined."""
    return row_count(read_table(spark, sf_dir, "lineitem").limit(10))


# --- streams ----------------------------------------------------------------------------------

EVENTS_SQL = "SELECT event_id, user_id, event_type, value FROM events"
_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _drain() -> dict[str, object]:
    return trigger_policy("ONCE")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of them."""
    table = read_table(spark, sf_dir, "events")
    name = table.select("_metadata.file_name").first()
    if name is not None and name.file_name == "events.parquet":
        return nested_file_stream(spark, sf_dir, table.schema, "events.parquet", "parquet")
    return folder_stream(spark, f"{sf_dir}/events.parquet", table.schema)


def _ingest_events(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "events")
    stream = _event_stream(spark, sf_dir)
    checkpoint = shared_folder(spark, "events-checkpoint")
    run_to_completion(append_stream_to_folder(stream, folder, checkpoint, _drain()))
    return folder


class _ReportedRows(ProgressLog):
    """Rows reported by run of a query, and which runs have ended."""

    def __init__(self):
        self.rows: dict[str, int] = defaultdict(int)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryProgress(self, event):
        super().onQueryProgress(event)
        self.rows[str(event.progress.runId)] += event.progress.numInputRows

    def onQueryTerminated(self, event):
        super().onQueryTerminated(event)
        self.ended[str(event.runId)].set()


@query("SELECT count(*) AS reported_rows, count(*) AS written_rows FROM events")
def stream_progress_rows(spark, sf_dir):
    """What the progress listener was told, next to what the stream wrote."""
    out, checkpoint = shared_folder(spark, "events"), shared_folder(spark, "events-checkpoint")
    listener = _ReportedRows()
    spark.streams.addListener(listener)
    try:
        stream = append_stream_to_folder(_event_stream(spark, sf_dir), out, checkpoint, _drain())
        run_to_completion(stream)
        run = str(stream.runId)
        if not listener.ended[run].wait(60):  # events come after the query has ended
            raise TimeoutError("the listener was not told of the end of the stream")
    finally:
        spark.streams.removeListener(listener)
    written = spark.read.parquet(out).agg(F.count("*").alias("written_rows"))
    return written.select(F.lit(listener.rows[run]).cast("long").alias("reported_rows"), "written_rows")


@query(EVENTS_SQL)
def stream_ingest(spark, sf_dir):
    return spark.read.parquet(_ingest_events(spark, sf_dir)).select(_EVENT_COLUMNS)


@query(EVENTS_SQL)
def stream_table_append(spark, sf_dir):
    """Into a table and, in a second stream, out of it again."""
    folder = shared_folder(spark, "events_table")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    checkpoint = shared_folder(spark, "checkpoint")
    run_to_completion(
        append_stream_to_table(
            _event_stream(spark, sf_dir), table, checkpoint, _drain(), path=folder
        )
    )
    out = shared_folder(spark, "events-out")
    again = table_stream(spark, table, max_files=1)
    checkpoint = shared_folder(spark, "checkpoint")
    run_to_completion(append_stream_to_folder(again, out, checkpoint, _drain()))
    return spark.read.parquet(out).select(_EVENT_COLUMNS)


@query(ORDER_FLAG_SQL)
def stream_two_hop(spark, sf_dir):
    """Raw customer documents into a folder by one stream, and out of it enriched by another."""
    source = documents_folder(spark, sf_dir, "customers")
    raw, out = shared_folder(spark, "first-hop"), shared_folder(spark, "second-hop")
    stream = folder_stream(spark, source, spark.read.parquet(source).schema)
    checkpoint = shared_folder(spark, "first-hop-checkpoint")
    run_to_completion(append_stream_to_folder(stream, raw, checkpoint, _drain()))
    _enrich_customers(spark, sf_dir, out, raw=raw)
    return customer_orders(spark.read.parquet(out).drop(BATCH))


@query(ORDER_FLAG_SQL)
def stream_resume(spark, sf_dir):
    """The same stream again on its own checkpoint: it finds nothing new and adds nothing."""
    out, checkpoint = shared_folder(spark, "enriched"), shared_folder(spark, "checkpoint")
    _enrich_customers(spark, sf_dir, out, checkpoint=checkpoint)
    _enrich_customers(spark, sf_dir, out, checkpoint=checkpoint)
    return customer_orders(spark.read.parquet(out).drop(BATCH))


@query(ORDER_FLAG_SQL)
def stream_replay_table(spark, sf_dir):
    """Every batch twice into a table that keeps a partition per batch."""
    out = shared_folder(spark, "enriched_table")
    table = out.rsplit("/", 1)[1].replace("-", "_")
    sink = replay_safe_table(table)
    _enrich_customers(spark, sf_dir, out, sink=sink)
    _enrich_customers(spark, sf_dir, out, sink=sink)
    return customer_orders(spark.table(table).drop(BATCH))


def _enrich_customers(
    spark: SparkSession,
    sf_dir: str,
    out: str,
    on_batch=None,
    max_files: int | None = None,
    raw: str | None = None,
    sink: Sink | None = None,
    checkpoint: str | None = None,
) -> None:
    raw = raw or documents_folder(spark, sf_dir, "customers")
    stream = folder_stream(spark, raw, spark.read.parquet(raw).schema, max_files=max_files)
    # The dimension is made once for all micro-batches.
    domain = order_flag_domain(spark, sf_dir)
    flags = shared_folder(spark, "order-flags")
    domain.dimension.write.parquet(flags)
    domain = replace(domain, dimension=spark.read.parquet(flags))
    query = enrich_stream(
        stream,
        lambda batch, observation: enrich(batch, [domain], observation=observation),
        sink or replay_safe_folder(out),
        checkpoint or shared_folder(spark, "enrich-checkpoint"),
        _drain(),
        on_batch,
    )
    run_to_completion(query)


@query(ORDER_FLAG_SQL)
def stream_enrich(spark, sf_dir):
    out = shared_folder(spark, "enriched")
    _enrich_customers(spark, sf_dir, out)
    return customer_orders(spark.read.parquet(out).drop(BATCH))


@query(ORDER_FLAG_SQL)
def stream_rate_limited(spark, sf_dir):
    """One file per micro-batch."""
    out = shared_folder(spark, "enriched")
    _enrich_customers(spark, sf_dir, out, max_files=1)
    return customer_orders(spark.read.parquet(out).drop(BATCH))


@query(ORDER_FLAG_SQL)
def stream_replay_idempotent(spark, sf_dir):
    """Every batch twice, as after a crash between the write and the commit."""
    out = shared_folder(spark, "enriched")
    _enrich_customers(spark, sf_dir, out)
    _enrich_customers(spark, sf_dir, out)
    return customer_orders(spark.read.parquet(out).drop(BATCH))


@query(METRICS_SQL)
def stream_metrics(spark, sf_dir):
    """Counts that rode along with the writes of the micro-batches, summed up."""
    seen = []
    _enrich_customers(
        spark, sf_dir, shared_folder(spark, "enriched"), lambda _, m: seen.append(m)
    )
    return _metrics_table(spark, seen)


@query(SUPPLIER_SQL)
def stream_repair(spark, sf_dir):
    """Enriched with half of the suppliers first; the batches that missed a name are repaired with all of them."""
    raw = documents_folder(spark, sf_dir, "orders")
    schema = spark.read.parquet(raw).schema
    suppliers = read_table(spark, sf_dir, "supplier").select(
        F.lit("suppliers").alias("domain"), F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name")
    )

    def names_in(reference: DataFrame):
        return lambda keys: key_pruned_reference(reference, keys, "id").select("domain", "id", "name")

    enriched = with_inner_field(schema, "suppliers", "lines", T.StructField("ENRICH", T.StringType()))
    output = RepairableOutput(
        spark,
        shared_folder(spark, "repairable"),
        enriched,
        keys=lambda docs: domain_keys(docs, {"suppliers": "suppKey"}, "bigint"),
        enrich=lambda docs, names: _looked_up(docs, names, ["suppliers"]),
        id_type="bigint",
    )
    half = names_in(suppliers.where("id % 2 = 0"))
    stream = folder_stream(spark, raw, schema, max_files=2).writeStream.trigger(**_drain())
    stream = stream.option("checkpointLocation", shared_folder(spark, "repairable-checkpoint"))
    run_to_completion(stream.foreachBatch(lambda batch, batch_id: output.write(batch, batch_id, half)).start())
    output.repair(names_in(suppliers))
    return order_lines(output.rows(), "suppliers", "suppKey")


@query("SELECT count(*) AS orders, TRUE AS same_documents FROM orders")
def stream_two_hop_reconciled(spark, sf_dir):
    """Digests of the documents that the first hop read and of what the second wrote, names left out."""
    source = documents_folder(spark, sf_dir, "customers")
    schema = spark.read.parquet(source).schema
    raw, out = shared_folder(spark, "first-hop"), shared_folder(spark, "second-hop")
    log = DigestLog()
    spark.streams.addListener(log)
    try:
        stream = digested(folder_stream(spark, source, schema, max_files=3))
        first = append_stream_to_folder(stream, raw, shared_folder(spark, "first-hop-checkpoint"), _drain())
        run_to_completion(first)
        read = log.total(first)
    finally:
        spark.streams.removeListener(log)
    domain = order_flag_domain(spark, sf_dir).stored()
    written = []
    second = enrich_stream(
        folder_stream(spark, raw, schema),
        lambda batch, observation: digested_as(enrich(batch, [domain]), schema, observation),
        replay_safe_folder(out),
        shared_folder(spark, "second-hop-checkpoint"),
        _drain(),
        lambda _, observed: written.append(digest_of(observed)),
    )
    run_to_completion(second)
    same = F.lit(read == add_digests(written)).alias("same_documents")
    return spark.read.parquet(out).agg(F.sum(F.size("orders")).alias("orders")).select("orders", same)


@query(f"SELECT * FROM ({ORDER_FLAG_SQL}) WHERE cust_key = (SELECT min(o_custkey) FROM orders)")
def stream_skip_empty_batches(spark, sf_dir):
    """One file per batch, filtered to one customer: batches without rows are neither transformed nor written."""
    raw = documents_folder(spark, sf_dir, "customers")
    docs = spark.read.parquet(raw)
    least = docs.agg(F.min("custKey")).first()[0]
    domain = order_flag_domain(spark, sf_dir).stored()
    out = shared_folder(spark, "enriched")
    write = replay_safe_folder(out)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            raise ValueError(f"batch {batch_id} has no rows")
        write(batch, batch_id)

    query = enrich_stream(
        folder_stream(spark, raw, docs.schema, max_files=1).where(F.col("custKey") == least),
        lambda batch, observation: enrich(batch, [domain], observation=observation),
        sink,
        shared_folder(spark, "enrich-checkpoint"),
        _drain(),
    )
    run_to_completion(query)
    return customer_orders(spark.read.schema(_enriched_customers(docs)).parquet(out).drop(BATCH))


def _enriched_customers(docs: DataFrame) -> T.StructType:
    return with_inner_field(docs.schema, "orders", "entries", T.StructField("ENRICH", T.StringType()))


@query(ORDER_FLAG_SQL)
def stream_append_only_table(spark, sf_dir):
    """Documents appended to a table in two parts, streamed out of it with options of the reader, enriched."""
    docs = documents(spark, sf_dir, "customers")
    table = shared_folder(spark, "customers_table").rsplit("/", 1)[1].replace("-", "_")
    part = F.pmod(F.xxhash64("custKey"), F.lit(2))
    domain = order_flag_domain(spark, sf_dir).stored()
    out, checkpoint = shared_folder(spark, "enriched"), shared_folder(spark, "enrich-checkpoint")
    create_document_table(spark, table, docs.schema)
    for i in range(2):
        # The second run finds only what was appended since the first.
        docs.where(part == i).write.mode("append").insertInto(table)
        query = enrich_stream(
            table_stream(spark, table, max_files=2, ignoreMissingFiles="true"),
            lambda batch, observation: enrich(batch, [domain], observation=observation),
            replay_safe_folder(out),
            checkpoint,
            _drain(),
        )
        run_to_completion(query)
    return customer_orders(spark.read.schema(_enriched_customers(docs)).parquet(out))


DECLARED_ORDERS = """
orderKey BIGINT,
suppliers ARRAY<STRUCT<suppKey: BIGINT, lines: ARRAY<STRUCT<lineNumber: BIGINT, quantity: DOUBLE>>>>
"""


@query(SUPPLIER_SQL.replace("l_linenumber AS", "l_linenumber::BIGINT AS"))
def stream_declared_schema(spark, sf_dir):
    """Documents stored as JSON text, which has no schema, streamed with a declared one."""
    text, raw = shared_folder(spark, "json-documents"), shared_folder(spark, "declared")
    documents(spark, sf_dir, "orders").write.json(text)
    stream = nested_file_stream(spark, text, T.StructType.fromDDL(DECLARED_ORDERS), "*.json", "json")
    run_to_completion(append_stream_to_folder(stream, raw, shared_folder(spark, "declared-checkpoint"), _drain()))
    return order_lines(enrich(spark.read.parquet(raw), [supplier_domain(spark, sf_dir)]), "suppliers", "suppKey")
