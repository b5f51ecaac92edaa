import pytest

from comparing import DATA, same
from weftline.plans import queries as core

SQL = core.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    same(spark, name, core.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(SQL)))
def test_runs_over_whole_tables(spark, name):
    assert core.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(core.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
