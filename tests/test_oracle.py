"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
SQL = entry.oracle_sql()
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "pages", "benchmark"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _rows(table):
    names = sorted(table.schema.names)
    return names, sorted(str([row[n] for n in names]) for row in table.to_pylist())


# Trained, sampled or greedy results without an SQL form; tests/llm holds them against brute force.
NO_SQL = {"op2_neighbours", "op3_language_id", "op4_resharding", "op5_pii", "op6_quality", "op8_packing", "op10_minhash", "pipeline"}


def test_only_these_have_no_sql():
    assert set(QUERIES) - set(SQL) <= NO_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf_dir, duck, name):
    ours = _rows(QUERIES[name](spark, sf_dir).toArrow())
    theirs = _rows(duck.execute(SQL[name]).to_arrow_table())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert ours[1]


def test_sample_does_not_depend_on_the_layout(inputs):
    from varloom.operators.sites import sample_rows

    rows = inputs.vcf().select("ROW_ID")
    some = {r.ROW_ID for r in sample_rows(rows, "ROW_ID", 0.3, 9).collect()}
    assert some == {r.ROW_ID for r in sample_rows(rows.repartition(7), "ROW_ID", 0.3, 9).collect()}
    assert 0.2 < len(some) / rows.count() < 0.4
    assert sample_rows(rows, "ROW_ID", 1.0).count() == rows.count() and sample_rows(rows, "ROW_ID", 0.0).count() == 0
