"""Every registered query against its SQL counterpart on another engine."""

import math
import os

import duckdb
import pytest
from conftest import ROOT, TESTDATA

import __spark_entry__ as entry
from receiptflow.plans.catalog import QUERIES
from receiptflow.plans.oracle import ORACLE

TABLES = [f.split(".")[0] for f in sorted(os.listdir(f"{TESTDATA}/sf0.01"))]


@pytest.fixture(scope="module")
def other(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    assert not any(isinstance(v, float) and math.isnan(v) for row in shaped for v in row)
    return sorted(columns), sorted(shaped, key=lambda row: [(v is None, str(type(v)), v) for v in row])


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_equals_sql(spark, other, sf_dir, name):
    answer = entry.queries()[name](spark, sf_dir)
    result = other.execute(entry.oracle_sql()[name])
    expected = sorted_rows([c[0] for c in result.description], result.fetchall())
    actual = sorted_rows(answer.columns, [tuple(row) for row in answer.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1]) > 0
    assert actual[1] == expected[1]


def test_library_queries_have_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert os.path.exists(f"{ROOT}/__spark_entry__.py")


def test_enriched_messages_are_parsed_twice_at_most(spark, sf_dir):
    """Once for the names, once for all fields."""
    from receiptflow.plans.catalog import encode_enriched

    plan = encode_enriched(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "get_json_object" not in plan


def test_hot_profile_reads_stored_transactions(spark, sf_dir, monkeypatch):
    """Counting and sampling must not work out the joins and the upsert again."""
    from receiptflow.plans import catalog

    seen, plain = [], catalog.profile

    def profile(df, *args, **kwargs):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(catalog, "profile", profile)
    catalog.enrich_current_hot(spark, sf_dir)
    assert seen and not any(word in plan for plan in seen for word in ("Join", "Window"))


def test_copies_of_a_receipt_meet_before_the_exchange(spark, sf_dir):
    """Orders are joined last, and a replayed slice holds only what makes a transaction."""
    from receiptflow.sources import tables

    tx = tables.transactions(spark, sf_dir)
    plan = tx._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("o_orderkey") < plan.index("p_partkey")
    lines = tables.load(spark, sf_dir, "lineitem").select(*tables.LINE)
    assert tables.as_transactions(lines, spark, sf_dir).exceptAll(tx).isEmpty()
