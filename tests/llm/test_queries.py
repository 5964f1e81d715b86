"""The registered queries against their SQL twins, column types included, and the shape of the rest."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_key  # noqa: E402
from strata.llm.queries import SQL, Q  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = Q[name](spark, SF)
    assert {c: TYPES[t] for c, t in df.dtypes} == {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    res = duck.execute(SQL[name])
    columns = [d[0] for d in res.description]
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(columns, res.fetchall())


def test_all_are_registered(spark):
    assert set(Q) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in Q if n.startswith("op")) == list(range(1, 14)) and "pipeline" in Q


@pytest.mark.parametrize("name", ["op2_toxicity", "op3_simhash", "op6_secrets", "op8_quality"])
def test_one_row_per_document(spark, name):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = Q[name](spark, SF)
    assert got.count() == n and got.select("doc_id").distinct().count() == n


@pytest.mark.parametrize("name", ["op6_secrets", "op9_mixing", "op10_chat"])
def test_native_queries_run_no_python(spark, name):
    plan = Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
