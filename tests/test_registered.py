"""Every registered query against its oracle SQL on the small tables."""

from __future__ import annotations

import pytest

from checks import compare, registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_matches_oracle(spark, sf_dir, con, key):
    df = registry.QUERIES[key](spark, sf_dir)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare.compare(df, con, registry.ORACLE[key]) is None


# Minutes even on the small tables: 100 rounds in each of six fits. tests/test_forecast.py fits it with fewer.
LONG = {"stacked"}


@pytest.mark.parametrize("key", sorted(set(registry.QUERIES) - set(registry.ORACLE) - LONG))
def test_gives_rows(spark, sf_dir, key):
    assert registry.QUERIES[key](spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_retail_table_is_the_same_at_every_size(spark):
    """Row counts and totals of the derived table."""
    from pyspark.sql import functions as F

    from shelftide.sources.retail import retail_hourly

    expected = {"sf0.001": (8640, 331772.394), "sf0.01": (86400, 3190326.482), "sf0.1": (864000, 32350796.581)}
    for name, (rows, total) in expected.items():
        df = retail_hourly(spark, f"/root/testdata/{name}")
        got = df.agg(F.count(F.lit(1)), F.sum(F.col("sale_amount").cast("decimal(18,4)")).cast("double")).first()
        assert (got[0], round(got[1], 4)) == (rows, total)
