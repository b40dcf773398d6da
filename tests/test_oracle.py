import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from marketloom.plans.queries import QUERIES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Their tables at this scale are below the row count that the SQL takes for granted.
SMALL_SCALE = {"normality_verdict", "lof_balances"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE and n not in SMALL_SCALE])
def test_query_equals_sql(spark, con, name):
    outcome = compare(spark, con, QUERIES[name], ORACLE[name], SF_DIR)
    assert outcome.startswith("ok"), outcome


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
