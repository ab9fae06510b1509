"""Every query against its SQL check on the smallest sample, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SAMPLES
from courtloom.plans.checks import CHECKS as CORE_CHECKS
from courtloom.plans.queries import QUERIES as CORE_QUERIES

CHECKS, QUERIES = contract.oracle_sql(), contract.queries()
TABLES = "orders customer nation lineitem part pages documents"
ROWS_ONLY = {"tree_accuracy", "tree_nodes", "feature_importance", "topic_tree_importance"}


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SAMPLES}/{table}.parquet'")
    return db


def normal(row):
    return tuple("" if v is None else str(v) for v in row)


def test_every_query_is_checked():
    # Queries of the llm folder are tested beside it; this library's own must each have SQL or be a model query.
    assert set(CORE_QUERIES) - set(CORE_CHECKS) == ROWS_ONLY
    assert set(CORE_CHECKS) <= set(CORE_QUERIES)
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SAMPLES)
    columns = sorted(frame.columns)
    found = sorted(normal(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect())
    result = db.execute(CHECKS[name])
    order = sorted(range(len(columns)), key=lambda i: result.description[i][0])
    assert [result.description[i][0] for i in order] == columns
    assert found == sorted(normal([r[i] for i in order]) for r in result.fetchall())
    assert found


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_model_query(spark, name):
    rows = QUERIES[name](spark, SAMPLES).collect()
    assert rows
    if name == "tree_accuracy":
        assert all(0 < r.accuracy <= 1 for r in rows)
    if name.endswith("importance"):
        assert abs(sum(r.importance for r in rows) - 1) < 1e-3


def test_entry(spark):
    assert contract.entry(spark).count() == 2368
