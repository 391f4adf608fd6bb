"""Registered queries against their SQL twins on the smallest tables; ``check.py`` runs all of them."""

from __future__ import annotations

import pytest

import check
from bindings.oracle_queries import ORACLE
from bindings.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Left to check.py: several stored snapshots each.
SLOW = ("dim_", "dws_", "serve_", "stream_", "speed_video", "exact_")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(SLOW)] + ["dws_order_source"])
def test_query_matches_its_sql(spark, con, name):
    good, note = check.compare(spark, con, name, SF_DIR)
    assert good, note


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)
