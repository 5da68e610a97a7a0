"""Queries that hold a state for each row deal rows out to more tasks the more there are, with the same results."""

import re

import duckdb
import pytest

from racelake.operators import dealing
from racelake.plans.oracle import ORACLES
from racelake.plans.queries import QUERIES
from test_queries import SF, TABLES, _plain


def numbers(df):
    """The numbers of tasks that a query asks for itself."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return {int(n) for n in re.findall(r"RepartitionByExpression \[.*\], (\d+)", plan)}


def sql(name):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.sql(ORACLES[name])
    return _plain(want.fetchall(), want.columns)


def grown(spark, monkeypatch, name, rows=500):
    monkeypatch.setattr(dealing, "TASK_ROWS", rows)
    got = QUERIES[name](spark, SF)
    assert _plain([tuple(r) for r in got.collect()], got.columns) == sql(name)
    return numbers(got)


def test_tasks_grow_with_rows(spark):
    assert [dealing.more_tasks(spark, n) for n in (None, 0, 4 * dealing.TASK_ROWS, 4 * dealing.TASK_ROWS + 1)] == [None, None, None, 5]


@pytest.mark.parametrize("name", ["period_audit", "repeated_keys", "collection_digests", "digest_binding", "matrix_meaning", "payout_meaning"])
def test_queries_ask_for_more_tasks(spark, monkeypatch, name):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert max(grown(spark, monkeypatch, name)) >= -(-lines // 500) > 4


def test_documents_are_read_by_all_tasks(spark):
    assert numbers(QUERIES["nested_group_rules"](spark, SF)) >= {int(spark.conf.get("spark.sql.shuffle.partitions"))}
