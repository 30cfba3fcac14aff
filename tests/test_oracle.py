"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import duckdb
import pytest

from fieldtally import queries
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events".split()


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_sql(spark, name):
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    own = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    cur = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert own == sorted((tuple(plain(r[i]) for i in order) for r in cur.fetchall()), key=str)


def test_every_query_has_sql():
    assert set(queries.oracle_sql()) == set(queries.queries())
