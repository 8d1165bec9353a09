"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from acctmart.checks import oracle, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_flag_takes_both_values():
    """Else a constant would pass the comparison."""
    con = duckdb.connect()
    for name in ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    for name in ("account_mart", "account_mart_billed"):
        result = con.execute(ORACLE[name])
        columns = [d[0] for d in result.description]
        rows = result.fetchall()
        for i, column in enumerate(columns):
            if column.lower().startswith(("fl_possui", "flgpossui", "fl_servico", "fl_envia", "fl_fatura")):
                assert {r[i] for r in rows} == {0, 1}, (name, column)
    assert con.execute(ORACLE["phone_rank"] + ' WHERE "rank" IS NULL').fetchall()
    assert con.execute(ORACLE["invoice_chunks"] + " WHERE id_fatura IS NULL").fetchall()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    order = [names.index(c) for c in columns]
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(names) == columns
    assert len(ours) > 0
    assert ours == theirs


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert len(result.columns) == 22
    assert result.count() > 0


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())
