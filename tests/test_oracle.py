"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from notesmith.plans import catalog
from tests.conftest import SF01
from tools.oracle_check import compare

QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}
ORACLE = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF01).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert compare(got, want) is None


def test_every_query_registered_with_oracle_or_listed():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["url_hash", "page_id", "url", "title"]
