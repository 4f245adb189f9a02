"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare
from wayfare import registry

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, DATA)
    assert compare(df, entry.oracle_sql()[name], DATA) > 0


def test_every_query_has_its_sql():
    assert registry.QUERIES.keys() == registry.ORACLE.keys()
    assert registry.QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", ["dq_nulls", "dq_duplicates", "dq_orphans", "dq_domains", "dq_payment_balance"])
def test_every_check_finds_something(spark, name):
    rows = entry.queries()[name](spark, "/root/testdata/sf0.01").collect()
    found = {}
    for row in rows:
        table = {k: v for k, v in row.asDict().items() if k in ("table_name", "column_name", "relation")}
        bad = next((row[c] for c in ("null_rows", "copies", "orphan_rows", "bad_rows") if c in row), 1)
        key = tuple(table.values())
        found[key] = found.get(key, 0) + bad
    wanted = {
        "dq_nulls": {(t, c) for t, columns in registry._REQUIRED.items() for c in columns},
        "dq_duplicates": {(name, column) for name, _, column in registry._UNIQUE},
        "dq_orphans": {(name,) for name, *_ in registry._REFERENCES},
        "dq_domains": {(name, column) for name, _, column, _ in registry._DOMAINS},
        "dq_payment_balance": {()},
    }[name]
    assert set(found) == wanted and all(bad > 0 for bad in found.values())
