"""Every registered query against its oracle SQL."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_oracle(spark, duck, name):
    assert differences(contract.queries()[name](spark, FOLDER), duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    row = contract.entry(spark).first().asDict()
    assert row == {"total": 35, "correct": 21, "incorrect": 14, "unknown": 10, "accuracy": 60.0}
