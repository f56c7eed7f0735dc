"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest
from tests.conftest import DATA

from sheafwork.plans.catalog import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(name, spark, duck, same_rows):
    same_rows(QUERIES[name](spark, str(DATA)).toPandas(), duck.execute(ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_repeats(name, spark, same_rows):
    first = QUERIES[name](spark, str(DATA)).toPandas()
    assert len(first)
    same_rows(QUERIES[name](spark, str(DATA)).toPandas(), first)


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 5
