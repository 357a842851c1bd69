"""Every recording query has the rows of its SQL."""

import math

import pytest

from reelspan.plans import registry


def plain(v):
    return ("nan" if math.isnan(v) else f"{v:.9g}") if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_rows_equal_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    left = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    assert left == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
