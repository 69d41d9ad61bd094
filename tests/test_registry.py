"""Every registered query gives what its SQL gives on the driver's tables."""

import pytest

import __spark_entry__ as entry
from conftest import DATA
from plumbline import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def _order(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    mine = sorted((tuple(row[n] for n in names) for row in df.collect()), key=_order)
    result = duck.execute(ORACLES[name])
    theirs_names = [column[0] for column in result.description]
    assert sorted(theirs_names) == names
    places = [theirs_names.index(n) for n in names]
    theirs = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=_order)
    assert mine == theirs


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_entry_has_all_queries():
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) >= set(ORACLES)
