"""Every registered query against its statement: same columns, types' values and rows, exactly."""

import pytest

import __spark_entry__ as contract
from tests.compare import check_engine, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return check_engine(SF)


OWN = [*contract.NAMES, *contract.WITH_ARGUMENTS, *contract.IN_RANGE, "leader_history"]  # the others are tested in tests/llm


@pytest.mark.parametrize("name", sorted(OWN))
def test_same_rows(spark, engine, name):
    df = contract.queries()[name](spark, SF)
    assert differences(df, engine, contract.oracle_sql()[name]) == ""


def test_every_query_has_a_statement():
    assert set(OWN) <= set(contract.queries()) & set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
