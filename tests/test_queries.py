"""Every query beside its SQL on the smallest data, where there is SQL; the others must give rows of a stable schema."""

import pytest

from compare import differences, duck
from sievework.plans import plans

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(plans()))
def test_query(spark, con, name):
    query, sql = plans()[name]
    frame = query(spark, DATA).toPandas()
    if sql:
        assert differences(frame, con.execute(sql).df()) == ""
    else:
        assert len(frame)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
