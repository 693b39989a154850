"""Every registered query against its SQL twin, and the entry module."""

import pytest

import __spark_entry__ as entry_module
from crawlqueries.layout_queries import ORACLE_SQL as LAYOUT_SQL
from crawlqueries.oracle import ORACLE_SQL
from compare import difference, open_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted({**ORACLE_SQL, **LAYOUT_SQL}))
def test_query_equals_sql(spark, tables, name):
    assert difference(entry_module.queries()[name], entry_module.oracle_sql()[name], spark, tables, SF) == ""


def test_queries_without_sql_belong_to_text_preparation():
    left = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert all(name.startswith("op") or name == "pipeline" for name in left)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["host", "n_urls"] and df.count() > 0
