"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

from cyclograph.workload import QUERIES, SQL
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    problem, _ = differences(spark, duck, FOLDER, QUERIES[name], SQL[name])
    assert problem is None, problem


def test_entry_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == [
        "station_id",
        "date_key",
        "trip_count",
        "crime_count_within_quarter_mile",
    ]
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
