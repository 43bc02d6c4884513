"""Every query with SQL gives DuckDB's rows; the others run and give a stable schema."""

import pytest
from oracle import differences, duck

from quillspark.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, data, con, name):
    only_spark, only_sql = differences(QUERIES[name](spark, data), SQL[name], con)
    assert not only_spark and not only_sql


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_core_does_not_import_llm():
    import pathlib

    import quillspark

    root = pathlib.Path(quillspark.__file__).parent
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert ".llm" not in p.read_text(), p
