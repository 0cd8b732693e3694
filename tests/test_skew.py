"""The queries on skewed copies of the tables: a third of all rows under one key, null keys,
copies of one row, missing and nameless reference rows. Hot keys are cut up from 200 rows on."""

import duckdb
import pytest

from nestweave.operators.spread import HotKeys
from nestweave.plans import order_documents
from nestweave.plans.queries import QUERIES, SQL

SKEWED = {
    "lineitem": """
        SELECT CASE WHEN hash(l_orderkey, l_linenumber, l_partkey, 1) % 3 = 0 THEN 7
                    ELSE l_orderkey END AS l_orderkey,
               CASE WHEN hash(l_orderkey, l_partkey, 2) % 3 = 0 THEN 11
                    ELSE l_partkey END AS l_partkey,
               CASE WHEN hash(l_orderkey, l_partkey, 3) % 3 = 0 THEN 5
                    ELSE l_suppkey END AS l_suppkey,
               * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM source
        UNION ALL SELECT one.* FROM (FROM source ORDER BY ALL LIMIT 1) one, range(2000)
    """,
    "orders": """
        SELECT o_orderkey,
               CASE WHEN hash(o_orderkey, 5) % 3 = 0 THEN 42
                    WHEN hash(o_orderkey, 6) % 10 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
               * EXCLUDE (o_orderkey, o_custkey) FROM source
    """,
    "supplier": """
        SELECT s_suppkey, CASE WHEN s_suppkey = 8 THEN NULL ELSE s_name END AS s_name,
               s_nationkey, s_acctbal FROM source WHERE s_suppkey <> 9
    """,
}
NAMES = [
    "nested_lookup_supplier",
    "nested_lookup_all_domains",
    "nested_lookup_all_domains_document_maps",
    "nested_lookup_order_flag",
    "nested_keys_of_documents",
    "nested_lookup_domains_with_misses",
    "key_pruned_orders",
    "any_domain_match_wide",
    "reference_union_dedup",
    "passthrough_array",
    "stream_replay_idempotent",
]


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    duck = duckdb.connect()
    for table in ("lineitem", "orders", "supplier", "part", "nation", "region", "events"):
        duck.execute(f"CREATE OR REPLACE VIEW source AS FROM '{sf_dir}/{table}.parquet'")
        select = SKEWED.get(table, "FROM source")
        duck.execute(f"COPY ({select}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    yield folder, duck
    duck.close()


@pytest.fixture
def low_floor(monkeypatch):
    find = HotKeys.find
    used = []

    def find_low(self, *args, **kwargs):
        found = find(HotKeys(floor=200, share=500), *args, **kwargs)
        used.append(any(table is not None for table in found.values()))
        return found

    monkeypatch.setattr(HotKeys, "find", find_low)
    return used


@pytest.mark.parametrize("name", NAMES)
def test_skewed_query_agrees_with_sql(spark, skewed, low_floor, name):
    folder, duck = skewed
    got = QUERIES[name](spark, folder).toArrow()
    want = duck.sql(SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns

    def rows(table):
        return sorted(map(repr, zip(*[table[c].to_pylist() for c in columns], strict=True)))

    assert rows(got) == rows(want)


def test_hot_keys_were_found(spark, skewed, low_floor):
    folder, _ = skewed
    QUERIES["nested_lookup_all_domains_document_maps"](spark, folder)
    assert any(low_floor)


def test_no_document_grows_with_its_order(spark, skewed):
    folder, duck = skewed
    docs = order_documents.documents(spark, folder, "orders")
    longest = max(len(r.quantities) for r in docs.select("quantities").collect())
    most = duck.sql("SELECT max(n) FROM (SELECT count(*) n FROM lineitem GROUP BY l_orderkey)")
    assert most.fetchall()[0][0] > 2000
    assert longest <= 2 * order_documents.MAX_LINES
