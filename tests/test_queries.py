"""Every registered query against its SQL text on the smallest scale folder."""

import os

import duckdb
import pytest

from compare import TABLES, rows_of
from offerscope.bindings import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_every_sql_text_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())
