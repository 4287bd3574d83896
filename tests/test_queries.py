"""Every registered query against its SQL, and windowed ones with very many ranges."""

import pytest

from starmart.operators.ranges import RANGES
from starmart.plans.queries import QUERIES, SQL
from tests.oracle import connect, spark_rows, sql_columns, sql_rows

WINDOWED = [
    "driver_standings", "team_standings", "team_rank", "team_season_rank",
    "every_nth", "paired_duration", "telemetry_messages",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert result.count() > 0
        return
    assert sorted(result.columns) == sql_columns(duck, SQL[name])
    got, want = spark_rows(result), sql_rows(duck, SQL[name])
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", WINDOWED)
def test_matches_sql_in_many_ranges(spark, sf_dir, duck, name):
    spark.conf.set(RANGES, "97")
    try:
        got = spark_rows(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset(RANGES)
    assert got == sql_rows(duck, SQL[name])
