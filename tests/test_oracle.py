"""Every deterministic query against its SQL on the smallest data; the others give rows."""

import pytest

import __spark_entry__ as entry_point
from reviewlens.testbed import catalog, check, oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, key):
    result = QUERIES[key](spark, SF_DIR)
    names, expected = check.oracle_rows(SF_DIR, ORACLES[key])
    rows = [tuple(row) for row in result.collect()]
    assert not check.differences(result.columns, rows, names, expected)


@pytest.mark.parametrize(
    "key", sorted(set(QUERIES) - set(ORACLES) - {"local_vs_overall_mixture"})
)
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, SF_DIR).limit(1).count() == 1


def test_half_a_mile_around_mixture_centers_may_be_empty(spark):
    rows = QUERIES["local_vs_overall_mixture"](spark, SF_DIR)
    assert rows.columns == QUERIES["local_vs_overall_rating"](spark, SF_DIR).columns
    rows.collect()


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(QUERIES)
    assert len(QUERIES) == 89
    assert not set(QUERIES) - set(entry_point.queries())


def test_entry_ranks_best_first(spark):
    ranks = [row["rank"] for row in entry_point.entry(spark).collect()]
    assert len(ranks) == 21
    assert ranks == sorted(ranks, reverse=True)
