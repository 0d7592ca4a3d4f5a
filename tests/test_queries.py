"""Every registered query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from meterloom.checks import oracle, registry
from tests.conftest import rows

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_runs(spark, base):
    assert entry_points.entry(spark).columns == [
        "measuring_point",
        "day",
        "active_energy",
        "reactive_energy_1",
    ]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, base, duck, name):
    result = duck.execute(ORACLE[name])
    columns = sorted(column[0] for column in result.description)
    order = sorted(range(len(columns)), key=lambda i: result.description[i][0])
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)

    df = QUERIES[name](spark, base)
    assert sorted(df.columns) == columns
    found = rows(df.select(*[f"`{column}`" for column in columns]))
    assert found == expected
    assert found, "the check compares nothing"
