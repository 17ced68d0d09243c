"""Queries of the training-data operators against their SQL, and all of them run."""

import duckdb
import pytest

import corpus_pipeline
from assayer.llm.oracle import ORACLE
from assayer.llm.queries import QUERIES

from ..test_oracle import TABLES, table


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.sql(ORACLE[name])
    assert table(df.columns, df.collect()) == table(result.columns, result.fetchall())


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [f.__name__ for _, f in corpus_pipeline.STAGES]


def test_functions_travel_by_value():
    from pyspark import cloudpickle

    from assayer.llm.secret_scan import base_spans

    assert b"assayer.llm.secret_scan\x94\x8c\nbase_spans" not in cloudpickle.dumps(base_spans)
