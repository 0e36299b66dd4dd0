"""Every registered query runs; those with SQL text give the same columns, types and rows in DuckDB."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from oracle import connect, difference

SF = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["user_id", "vc", "pu", "er"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    assert difference(df, con, sql) is None
    described = {c[0]: str(c[1]) for c in con.execute(sql).description}
    assert {c: TYPES[t] for c, t in df.dtypes} == described


OUTSIDE = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["q33b_forest_shap_adds_up"](spark, {sf!r}).count())
"""


def test_workers_need_no_package_on_their_path(tmp_path):
    """A plain session, started elsewhere: the Python workers cannot import the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = OUTSIDE.format(path=os.path.abspath(entry.__file__), sf=SF)
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "rows 500" in run.stdout, run.stderr[-2000:]
