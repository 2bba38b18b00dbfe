"""Registered queries against their SQL on the smallest tables; the sequential ones must return rows."""

import oracle
import pytest

from fieldlens.plans.catalog import REGISTRY


@pytest.fixture(scope="module")
def con(small_dir):
    return oracle.connect(small_dir)


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_matches_sql(spark, con, small_dir, name):
    q = REGISTRY[name]
    assert oracle.compare(q.run(spark, small_dir), con, q.sql) is None


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if not q.sql))
def test_runs(spark, small_dir, name):
    df = REGISTRY[name].run(spark, small_dir)
    assert len(set(df.columns)) == len(df.columns)
    df.count()
