import __spark_entry__ as entry
import pytest
from workloads import batch, oracles, rides, streams
from oracle_check import difference, oracle_frame, oracle_types, spark_types

SF = "/root/testdata/sf0.001"
CORE = {**batch.QUERIES, **rides.QUERIES, **streams.QUERIES}
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_every_core_query_has_an_oracle():
    assert set(CORE) <= set(QUERIES) and set(CORE) == set(oracles.oracles())


def test_entry(spark):
    out = entry.entry(spark)
    assert len(out.columns) == 58 and out.count() == 6000


@pytest.mark.parametrize("name", CORE)
def test_query_equals_sql(spark, name):
    ours = QUERIES[name](spark, SF)
    assert spark_types(ours) == oracle_types(SF, SQL[name])
    assert difference(ours.toPandas(), oracle_frame(SF, SQL[name])) is None
