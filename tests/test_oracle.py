"""Registered queries against their SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from courtside.plans.registered import QUERIES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # The nested document has no flat form; its summary is compared instead. What is trained
    # or hashed has no SQL; tests/llm compares it with brute force.
    without = set(entry.queries()) - set(entry.oracle_sql())
    assert {n for n in without if not n.startswith("op")} <= {"dashboard", "pipeline"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert check_oracle.compare(spark, con, SF, name) == ""


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["season_id", "team", "rank"]
