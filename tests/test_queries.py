"""Every registered query with a SQL twin against that twin on the smallest tables."""

import os

import duckdb
import pytest

from framewright import file_queries  # noqa: F401 - registers its queries
from framewright.oracle import SQL
from framewright.queries import QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def twin():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def test_all_have_twins():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_twin(spark, twin, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    found = twin.execute(SQL[name])
    at = {d[0]: i for i, d in enumerate(found.description)}
    assert sorted(at) == columns
    assert got == sorted(repr([plain(r[at[c]]) for c in columns]) for r in found.fetchall())
