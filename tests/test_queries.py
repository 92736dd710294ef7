"""Every query of the engine against its SQL, on the smallest tables."""

import pytest
from helpers import SMALL, canonical

from docmill.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, oracle, name):
    assert canonical(QUERIES[name](spark, SMALL).toPandas()) == canonical(oracle.execute(ORACLE[name]).df())


def test_all_have_an_oracle():
    assert set(QUERIES) == set(ORACLE)
