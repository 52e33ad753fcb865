"""Every registered query against its SQL oracle, all rows compared."""

import pytest

import __spark_entry__ as entry_point
from testbed.compare import connect, differences
from testbed.oracles import ORACLES
from testbed.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    rows, problems = differences(
        QUERIES[name](spark, sf_dir), duck, ORACLES[name]
    )
    assert not problems
    assert rows > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == [
        "bandeira_cartao",
        "qtd_movimentacoes",
        "valor_total",
    ]
