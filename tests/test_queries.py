"""Every registered query of the star schema against its SQL, on the smallest tables."""

import duckdb
import pytest

from racelake.plans.oracle import ORACLES
from racelake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def _plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: f"{v + 0.0:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _plain([tuple(r) for r in got.collect()], got.columns) == _plain(want.fetchall(), want.columns)
