"""Operators on small worlds against their known answers."""

from __future__ import annotations

import pytest
from tests.fixed_worlds import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_known_answer(name, spark, duck, same_rows):
    same_rows(QUERIES[name](spark, "").toPandas(), duck.execute(ORACLE[name]).df())
