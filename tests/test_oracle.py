"""Every registered query with a SQL oracle agrees with DuckDB on the small fixture."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import duck, normalise

from conftest import SF_SMALL

SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    a = normalise(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQLS[name])
    b = normalise([d[0] for d in cur.description], cur.fetchall())
    assert a == b


def test_every_query_runs_and_has_rows_or_is_empty(spark):
    for name, fn in E.queries().items():
        if name in SQLS:
            continue
        assert fn(spark, SF_SMALL).count() > 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1
