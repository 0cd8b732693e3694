"""Nested documents made from the flat order tables, so that lookups can be run and checked on them.

An order document holds the lines of one order three times over: under their suppliers, under
their parts and under the nations of their suppliers. A customer document holds the orders of one
customer. Documents, and the wide reference that goes with them, are stored once per session in the
shared folder, as the first hop of the pipeline would store them, and read from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.operators.spread import HotKeys, spread_join, spread_joins
from nestweave.session import shared_folder

# Longest document: an order with more lines becomes several documents with the same key.
MAX_LINES = 256

_stored: dict[tuple[str, str, str], str] = {}


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_row_number(scan: DataFrame) -> DataFrame:
    return scan.withColumn("_row", F.monotonically_increasing_id())


def nest_rows(
    rows: DataFrame,
    key: str,
    item: Column,
    alias: str,
    max_rows: int = MAX_LINES,
    hot_keys: HotKeys = HotKeys(),
) -> DataFrame:
    """Collects ``item`` of the rows of each key into arrays of about ``max_rows`` at most.

    Keys with more rows are counted first and cut into several documents, so no array grows with
    the data. ``rows`` comes straight from a scan: the row numbers that cut a key up are then the
    same when a task is retried; hashed, they spread a key evenly however it recurs. Rows that come from further away bring a ``_row`` of their own.
    """
    numbered = rows if "_row" in rows.columns else with_row_number(rows)
    long = (
        rows.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > max_rows)
        .select(key, F.ceil(F.col("_n") / max_rows).alias("_parts"))
    )
    cut = spread_join(numbered, long, key, "left", hot_keys).withColumn(
        "_part", F.pmod(F.xxhash64("_row"), F.coalesce(F.col("_parts"), F.lit(1)))
    )
    return cut.groupBy(key, "_part").agg(F.collect_list(item).alias(alias)).drop("_part")


def group_items(items: str, field: str, inner: str) -> Column:
    """``items`` regrouped as one struct per value of ``field`` with the items that have it."""
    values = F.array_distinct(F.col(items).getField(field))

    def group(value: Column) -> Column:
        same = F.filter(items, lambda x: x.getField(field).eqNullSafe(value))
        kept = F.transform(same, lambda x: F.struct(x["lineNumber"], x["quantity"]))
        return F.struct(value.alias(field), kept.alias(inner))

    return F.transform(values, group)


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_row_number(
        read_table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey"
        )
    )
    suppliers = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    item = F.struct(
        F.col("l_linenumber").alias("lineNumber"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_suppkey").alias("suppKey"),
        F.col("l_partkey").alias("partKey"),
        F.col("s_nationkey").alias("nationKey"),
    )
    rows = spread_join(lines, suppliers, "l_suppkey", "left")
    return nest_rows(rows, "l_orderkey", item, "lines").select(
        F.col("l_orderkey").alias("orderKey"),
        group_items("lines", "suppKey", "lines").alias("suppliers"),
        group_items("lines", "partKey", "lines").alias("parts"),
        group_items("lines", "nationKey", "lines").alias("nations"),
        F.col("lines.quantity").alias("quantities"),
    )


def _customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    entry = F.struct(
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("totalPrice")
    )
    item = F.struct(F.col("o_orderkey").alias("orderKey"), F.array(entry).alias("entries"))
    return nest_rows(orders, "o_custkey", item, "orders").withColumnRenamed("o_custkey", "custKey")


def _wide_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A denormalised reference: one row per line with the ids and names of three domains."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = read_table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    rights = {
        "l_suppkey": suppliers.select(
            F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_nationkey", "n_name"
        ),
        "l_partkey": read_table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), "p_name"
        ),
    }
    wide = spread_joins(lines, rights, "inner")
    return wide.select(
        F.col("l_suppkey").alias("s_suppkey"),
        "s_name",
        F.col("l_partkey").alias("p_partkey"),
        "p_name",
        "n_nationkey",
        "n_name",
        "l_shipdate",
    )


_BUILDERS = {
    "orders": _order_documents,
    "customers": _customer_documents,
    "reference": _wide_reference,
}


def documents_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The folder with the documents of ``kind``, written on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _stored:
        folder = shared_folder(spark, f"{kind}-documents")
        _BUILDERS[kind](spark, sf_dir).write.option("compression", "zstd").parquet(folder)
        _stored[key] = folder
    return _stored[key]


def documents(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(documents_folder(spark, sf_dir, kind))


def flatten_documents(
    docs: DataFrame, key: str, array: str, id_field: str, inner: str, *fields: Column
) -> DataFrame:
    """One row per inner element: the document key, the outer id and ``fields`` of ``item``."""
    outer = docs.select(F.col(key), F.explode(array).alias("outer"))
    rows = outer.select(
        F.col(key),
        F.col("outer").getField(id_field).alias("id"),
        F.explode(F.col("outer").getField(inner)).alias("item"),
    )
    return rows.select(F.col(key), "id", *fields)
