"""Every registered query against its SQL on the smallest tables; the others must give rows."""

import pytest

import __spark_entry__ as entry
from broadsheet import catalog
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
# Queries that may be empty on the smallest tables.
MAY_BE_EMPTY = {"jb9_content_kit", "jb10_release", "cl1_repeated_word", "fl9_enabled_sources", "jn6_similar_titles", "jn7_band_join", "jn7_resolve_sources", "cl17_warning_triage", "cl14_language_audit"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        empty = fn(spark, SF).isEmpty()
        assert name in MAY_BE_EMPTY or not empty
        return
    problem = compare(spark, con, name, fn, sql, SF)
    assert problem is None or (problem == "empty" and name in MAY_BE_EMPTY), problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
