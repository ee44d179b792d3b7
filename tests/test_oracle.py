"""Every registered query with an oracle matches DuckDB at sf0.001."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import digest, duck

from .conftest import SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1 and "roc_auc" in df.columns
