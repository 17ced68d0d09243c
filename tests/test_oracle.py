"""Every query against its SQL counterpart, on whole tables."""

import math
import subprocess
import sys

import duckdb
import pytest
from pyspark import cloudpickle

import __spark_entry__ as entry
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROWS_ONLY = set()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    body = sorted(tuple(canonical(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], body


SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    result = duck.sql(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table(result.columns, result.fetchall())
    assert {c: SQL_TYPE[t] for c, t in df.dtypes} == dict(
        zip(result.columns, map(str, result.types))
    )


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scorer_needs_no_module_on_executors(tmp_path):
    from workloads.queries import _rule_factory

    code = "import pickle, sys; f = pickle.load(sys.stdin.buffer); print(f()(['a Profit'])[0][0])"
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(_rule_factory()),
                          cwd=tmp_path, capture_output=True, timeout=60)
    assert done.stdout == b"positive\n", done.stderr


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["examples"] == 6000 and "relative_accuracy_lift" in row.asDict()


def test_classifier_chain_beats_nothing_but_scores_all(spark, sf_dir):
    scored = entry.queries()["classifier_predictions"](spark, sf_dir).collect()
    assert scored and all(0 < r["confidence"] <= 1 for r in scored)
    lift = entry.queries()["classifier_lift"](spark, sf_dir).first()
    assert lift["examples"] == len(scored) and lift["invalid_label_rate"] == 0.0
