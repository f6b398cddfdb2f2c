import pytest
from compare import assert_same, oracle_rows

from driftledger.plans.oracles import ORACLES
from driftledger.plans.registry import QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name])


def test_all_five_verdicts_occur():
    _, rows = oracle_rows("/root/testdata/sf0.01", f"SELECT DISTINCT verdict FROM ({ORACLES['correlate']})")
    assert len(rows) == 5
