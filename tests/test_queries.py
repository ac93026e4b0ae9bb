"""Each query against its SQL on the smallest tables, as the driver does on larger ones."""

import duckdb
import pyarrow as pa
import pytest

from tidewell.plans import composed, editorial  # noqa: F401
from tidewell.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(table: pa.Table) -> list:
    names = sorted(table.column_names)
    return sorted(repr(tuple(r[n] for n in names)) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toArrow(), duck.execute(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
