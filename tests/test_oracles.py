"""Every registered query against its SQL, on the smallest driver tables, with hot-key paths on."""

import pytest
from compare import connect, difference
from conftest import SF

from idloom.plans import catalog, oracle


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, hot, con, name):
    assert difference(catalog.queries()[name](spark, SF), con, oracle.ORACLE[name]) is None


def test_counts_of_the_full_resolution(spark):
    got = {r["match_type"]: r["count"] for r in catalog.queries()["match_types"](
        spark, "/root/testdata/sf0.01").groupBy("match_type").count().collect()}
    assert got == {"NEW_WITH_DOCUMENT": 1341, "MATCHED_DOCUMENT": 937, "NEW_NO_DOCUMENT": 119,
                   "MOBILE_APP_NEW": 88, "MOBILE_APP_UPDATE": 14}
