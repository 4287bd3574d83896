"""The registered text queries against their SQL; those without SQL are tested beside their operators."""

import pytest

import __spark_entry__
from starmart.llm.queries import QUERIES, SQL
from tests.oracle import connect, spark_rows, sql_columns, sql_rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    duck = connect(sf_dir)
    result = QUERIES[name](spark, sf_dir)
    assert sorted(result.columns) == sql_columns(duck, SQL[name])
    assert spark_rows(result) == sql_rows(duck, SQL[name])


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
