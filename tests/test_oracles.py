from __future__ import annotations

import os
import time

import pytest

import __spark_entry__ as contract
from cohortum.plans import catalogue
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def other():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_oracle(spark, other, name):
    start = time.time()
    compare(QUERIES[name](spark, FOLDER), other, ORACLES[name])
    print(f"{name}: {time.time() - start:.1f} s")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_of_the_library_has_an_oracle():
    assert set(catalogue.QUERIES) <= set(ORACLES)
