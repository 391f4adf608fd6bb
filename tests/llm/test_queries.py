from __future__ import annotations

import pytest

import check
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    good, note = check.compare(spark, check.connect(sf_dir), name, sf_dir)
    assert good, note


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
