"""Every query that has SQL gives the rows that SQL gives."""

import pytest
from check import compare

from tagspark.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, con, folder):
    message, _ = compare(con, spark, folder, QUERIES[name], ORACLES[name])
    assert message is None, message


def test_every_sql_text_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["tag_a", "tag_b", "count", "lift", "pmi"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
