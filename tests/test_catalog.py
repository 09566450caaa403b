import __spark_entry__ as entry_point
import pytest
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    status, _, _, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert status in ("ok", "rows-only"), status


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows
    assert all(0 <= r.threat_score <= 100 and 0 <= r.certainty <= 1 for r in rows)
    assert [r.threat_score for r in rows] == sorted((r.threat_score for r in rows), reverse=True)
