"""The registered training-data queries against their DuckDB SQL, and their shape."""

import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as ENTRY
from fleetscope.llm.queries import ORACLE, QUERIES
from tools.check_oracle import TABLES, rows_of

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = set(ENTRY.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE) <= set(ENTRY.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF001)
    # rows as objects: pandas would turn integers beside nulls into floats
    scols, srows = rows_of(pd.DataFrame(list(map(tuple, got.collect())), columns=got.columns, dtype=object))
    ocols, orows = rows_of(con.execute(ORACLE[name]).df())
    assert scols == ocols
    assert Counter(srows) == Counter(orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_for_each_input_row(spark, name):
    table, key = ("embeddings", "vec_id") if name.startswith("op1_") else ("documents", "doc_id")
    got = sorted(r[0] for r in QUERIES[name](spark, SF001).select(key).collect())
    assert got == sorted(r[0] for r in spark.read.parquet(f"{SF001}/{table}.parquet").select(key).collect())


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith(("op6_", "op10_", "op11_"))])
def test_native_queries_plan_no_python(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
