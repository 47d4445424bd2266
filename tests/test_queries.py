"""Each registered query of the catalogue against its SQL."""

import os

import duckdb
import pytest

from blockloom.plans.catalog import QUERIES
from blockloom.plans.oracles import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    return sorted(repr(tuple(str(x) for x in r)) for r in frame[sorted(frame)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found, expected = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(found) == sorted(expected)
    assert rows(found) == rows(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
