"""Driver contract: entry(), queries() and oracle_sql(), checked on sf0.001."""

import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry_mod
from logpulse.plans.catalog import QUERIES
from logpulse.plans.compare import compare, duck_connection
from logpulse.plans.oracle import ORACLE_SQL


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert [f.name for f in df.schema.fields] == [
        "window_start", "window_end", "total_entries", "error_count", "error_rate", "severity"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE_SQL) <= set(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, duck, key):
    got = entry_mod.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(entry_mod.oracle_sql()[key]).df()
    assert compare(got, want) is None
