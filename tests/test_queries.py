"""Every registered query with an oracle agrees with it; the others return rows of a stable schema."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from helixframe import catalog
from tests.compare import DATA, connect, differences

ORACLES, QUERIES = catalog.oracle_sql(), catalog.queries()


@pytest.fixture(scope="module")
def con():
    return connect("sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    assert differences(spark, QUERIES[name], ORACLES[name], con=con) == []


def test_every_query_without_sql_has_a_twin():
    """Queries that SQL cannot express are held against brute force in tests/test_twins.py."""
    text = (Path(__file__).parent / "test_twins.py").read_text()
    assert all(f'"{name}"' in text for name in set(QUERIES) - set(ORACLES))


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(QUERIES) <= set(entry.queries())


def test_plans_join_by_key(spark):
    for name in ("band_join", "gap_cover_join", "kmer_seed_join", "jaccard_shared_groups", "containment_pairs"):
        plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
