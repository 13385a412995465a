"""Driver contract: the flagship runs and every oracle has a query."""
import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["review_id", "aspects", "polarity"]


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
