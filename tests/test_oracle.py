"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from groundsill.plans.catalog import ON_STAGES, QUERIES
from groundsill.plans.oracle import oracle_sql
from groundsill.plans.stages import Stages

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def stages(spark):
    """One chain for all queries, so that stages written once are written once for all."""
    return Stages(spark, SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql()) == set(ON_STAGES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(stages, con, key):
    df = ON_STAGES[key](stages)
    assert difference(df, con, oracle_sql()[key]) is None


def test_flagship_runs(spark):
    assert contract.entry(spark).count() > 0
