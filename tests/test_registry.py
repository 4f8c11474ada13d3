"""The registered queries hang together, and a few of them agree with their SQL."""

from __future__ import annotations

import importlib.util
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from workload.registry import REGISTERED  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"
SAMPLE = [
    "messages_to_velocity", "latest_state", "state_from_log", "alert_groups", "alert_rule_buckets", "dedup_replays", "raw_vs_final_counts", "rules_all", "alert_feed", "alert_tick", "top_merchants", "health_summary",
    "tps_series", "topic_tail", "apply_ledger", "resolve_merchant", "rule_scores", "stream_ingest",
]


@pytest.fixture(scope="module")
def contract():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_every_query_has_a_check(contract):
    queries, sql = contract.queries(), contract.oracle_sql()
    assert len(queries) > 100 and set(sql) <= set(queries)
    assert set(REGISTERED) <= set(sql)  # others may be beyond SQL


@pytest.mark.skipif(not os.path.isdir(DATA), reason="supplied tables are absent")
def test_entry(contract, spark):
    assert contract.entry(spark).columns == ["account_id", "txn_count", "total_amount", "window_start", "window_end"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="supplied tables are absent")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(contract, spark, name):
    con = duckdb.connect()
    for table in ("customer", "supplier", "orders", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    cursor = con.execute(contract.oracle_sql()[name])
    columns = sorted(c[0] for c in cursor.description)
    index = {c[0]: i for i, c in enumerate(cursor.description)}
    want = sorted(repr([row[index[c]] for c in columns]) for row in cursor.fetchall())
    df = contract.queries()[name](spark, DATA)
    assert sorted(df.columns) == columns
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == want
