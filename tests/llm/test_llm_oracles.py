"""Every registered query with SQL must equal that SQL; all of them are registered."""

import re

import pytest

import __spark_entry__ as contract
from earshot.checks.compare import differences, duck
from earshot.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    found = contract.queries()
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in found) if m)
    assert numbers == list(range(1, 14)) and "pipeline" in found
    assert set(QUERIES) <= set(found) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, folder), duck(folder), ORACLES[name]) == []
