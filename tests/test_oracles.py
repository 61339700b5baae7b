"""Every registered query against its oracle, on the smallest tables.

``CALLSIFT_SF`` picks another folder of the test data.
"""

import os

import pytest

import __spark_entry__ as entry
from check_oracles import DATA, compare, duck

FOLDER = DATA / os.environ.get("CALLSIFT_SF", "sf0.001")
# of the optional subpackage; its own tests hold these against brute force
OWN_TESTS = [n for n in entry.queries() if n == "pipeline" or n.split("_")[0].removeprefix("op").isdigit()]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test data")
@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in OWN_TESTS])
def test_query(spark, con, name):
    outcome = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)
    assert outcome.startswith("ok"), outcome


def test_entry(spark):
    assert entry.entry(spark).columns


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
