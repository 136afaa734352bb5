"""Every registered query against its SQL, on the smallest given tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
    conversations""".split()
# The training-data queries have their own tests.
OWN = [k for k in entry.queries() if k != "pipeline" and not re.match(r"op\d+_", k)]
QUERIES, SQL = ({k: v for k, v in named.items() if k in OWN} for named in (entry.queries(), entry.oracle_sql()))
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def _plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_only_the_forest_goes_without_sql():
    assert set(QUERIES) - set(SQL) == {"anomaly_alerts"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_its_sql(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[key]}").fetchall()}
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields} == types
    got = _plain([tuple(r) for r in df.collect()], df.columns)
    cursor = duck.execute(SQL[key])
    want = _plain(cursor.fetchall(), [c[0] for c in cursor.description])
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
