"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive value hash)."""

import duckdb
import pytest

from arearisk.plans.registry import ORACLE, QUERIES
from arearisk.sources.tables import TABLES, table_path
from conftest import SF001
from tools.oracle_check import digest

# Spark type name -> DuckDB type name
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF001, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    ocols, want = list(rel.columns), rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    otypes = dict(zip(ocols, [str(t) for t in rel.types]))
    assert {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields} == otypes
    assert len(got) == len(want)
    assert digest(cols, got)[0] == digest(ocols, want)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF001).count() >= 0
