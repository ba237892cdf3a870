"""Every registered query of the engine against its SQL."""

import duckdb
import pytest

from pulseframe.plans import queries, sql

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    got, want = queries.queries()[name](spark, sf_dir).toArrow(), duck.sql(sql.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    columns = sorted(got.column_names)
    table = lambda t: sorted(map(repr, zip(*[t.column(c).to_pylist() for c in columns])))
    assert table(got) == table(want)


def test_more_remembered_files_than_tasks(spark, tmp_path):
    """2,100 files of two orders each, half of them new on the second look."""
    duckdb.sql(f"copy (select k * 1000 + r as o_orderkey, chr(65 + (k % 7)::int) as o_orderstatus from range(2100) a(k), range(2) b(r)) to '{tmp_path}/orders.parquet'")
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    got = [r["digest"] for r in queries.queries()["remembered_files"](spark, str(tmp_path)).collect()]
    want = [r[0] for r in con.execute(sql.oracle_sql()["remembered_files"]).fetchall()]
    assert sorted(got) == sorted(want)


def test_every_query_has_sql_but_file_digests():
    assert set(queries.queries()) - set(sql.oracle_sql()) == {"file_fingerprints"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(queries.queries()) <= set(__spark_entry__.queries())
