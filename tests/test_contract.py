"""Every registered query against its SQL, at the smallest scale."""

import pytest
from contract_check import DATA, connect, differences

import __spark_entry__ as contract
from contract.queries import QUERIES

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, SF) is None


def test_only_fitted_models_lack_sql():
    without = set(QUERIES) - set(contract.oracle_sql())
    assert without == {"train_gbt_metrics", "train_weighted_metrics", "train_score"}


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 16 and df.count() == 1000
