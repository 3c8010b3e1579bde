import pytest

import __spark_entry__ as registered
from check_oracle import compare

SMALL = "/root/testdata/sf0.001"


def test_flagship(spark):
    df = registered.entry(spark)
    assert len(df.columns) == 63 and df.count() > 0


def test_flagship_as_users_run_it(spark):
    """With whole-stage code generation, which the other tests do without."""
    key = "spark.sql.codegen.wholeStage"
    spark.conf.set(key, "true")
    try:
        assert compare(spark, SMALL, "enriched_base") is None
    finally:
        spark.conf.set(key, "false")


OWN = [name for module in registered.OWN for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) == {name for module in registered.OWN for name in module.ORACLES}


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SMALL, name) is None
