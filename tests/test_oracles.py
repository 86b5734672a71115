"""Every registered query against its SQL on the smallest test tables."""

import pytest

from compare import difference, duck
from fleetlake.catalog.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_most_queries_have_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"profile_columns_approx"}
