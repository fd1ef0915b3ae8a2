import pytest
from compare import difference, expected

import __spark_entry__ as entry_point
from peerline.registry.oracle import ORACLE
from peerline.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_entry_point_holds_the_registry():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {"metrics", "focal", "peer_group", "difference"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), ORACLE[name], FOLDER) is None
    assert expected(ORACLE[name], FOLDER)[1], "an empty result proves nothing"
