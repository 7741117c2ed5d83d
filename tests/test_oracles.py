"""Every query against its SQL form on the smallest tables."""

import pytest

from catalog.compare import connect, difference
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from tests.helpers import exploded_plan


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = exploded_plan(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    got = df.toPandas()
    assert difference(got, duck.execute(ORACLES[name]).df()) is None


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
