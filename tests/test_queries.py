"""Every registered query against its oracle, and the entry query."""

import pytest

import __spark_entry__ as contract
from tests.compare import compare, oracle_connection
from tests.conftest import TINY
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(TINY)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, connection, name):
    assert compare(spark, connection, name, TINY) == []


def test_every_order_is_scored(spark):
    scored = contract.queries()["o57_delivery_model"](spark, TINY)
    orders = spark.read.parquet(f"{TINY}/orders.parquet")
    assert scored.count() == scored.select("order_id").distinct().count() == orders.count() > 0
    assert scored.where("predicted_hours IS NULL OR isnan(predicted_hours)").isEmpty()
    assert set(QUERIES) - set(ORACLES) == {"o57_delivery_model"}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["key", "lsn", "op", "status", "event_time", "value"]
    assert 0 < df.count() <= 15


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
