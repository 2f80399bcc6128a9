import __spark_entry__ as contract
from workload.entries import queries
from shelfweek.schemas import FACT
from workload.oracle import oracle_sql


def test_flagship_query(spark):
    fact = contract.entry(spark)
    assert fact.columns == FACT
    assert fact.count() == 16_426


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()
    assert queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().items() >= oracle_sql().items()
