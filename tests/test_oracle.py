"""Every registered query against its SQL on the smallest tables."""

import re

import oracle
import pytest

from __spark_entry__ import oracle_sql, queries
from clickloom.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    difference = oracle.compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER)
    assert difference is None, difference


# Queries of which an input is read for two different purposes, with the scans that takes.
MORE_SCANS = {
    "identity_change_audit": 2,  # records and changes, before and after the remap
    "chained_uid_changes": 2,  # a chain's hops and its ends
    "group_recommender": 1, "group_recommender_lines": 1,  # both ends of a pair against the online list
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_on_the_engine_and_read_once(spark, name):
    """No Python, no cross join; not more scans than inputs plus one, whatever the inputs are."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    scans = re.findall(r"FileScan \w+ .*?Location: \w+(?:\(\d+ paths\))?\[([^\]]*)\]", plan)
    allowed = len(set(scans)) + 1 + MORE_SCANS.get(name, 0)
    assert len(scans) <= allowed, (name, len(scans), allowed)
