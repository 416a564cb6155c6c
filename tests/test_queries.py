"""Every query of the library against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from codexlake.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, duck, run, sql):
    frame = run(spark, DATA)
    columns = sorted(frame.columns)
    got = sorted_rows([tuple(r[c] for c in columns) for r in frame.collect()])
    cursor = duck.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == sorted_rows([tuple(dict(zip(names, r))[c] for c in columns) for r in cursor.fetchall()])
    return got


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, registry.QUERIES[name], registry.ORACLE_SQL[name])  # no query is empty on both sides


@pytest.mark.parametrize("name", ["library_summary", "library_summary_totals"])
def test_query_equals_sql_with_large_keys(spark, tmp_path, name):
    """Keys of part beyond 100,000: they must not run into the size class that a book's size holds."""
    con = duckdb.connect()
    for t in TABLES:
        moved = "SELECT * REPLACE (p_partkey + 60000 * (p_partkey % 40) AS p_partkey)" if t == "part" else "SELECT *"
        con.execute(f"COPY ({moved} FROM '{DATA}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    assert compare(spark, con, lambda s, _: registry.QUERIES[name](s, str(tmp_path)), registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["library_summary_totals"])
def test_query_equals_sql_without_books(spark, tmp_path, name):
    """A library without books: the total over all languages is a row of zeros."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"COPY (SELECT * FROM '{DATA}/{t}.parquet'{' LIMIT 0' if t in ('part', 'customer') else ''}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    assert compare(spark, con, lambda s, _: registry.QUERIES[name](s, str(tmp_path)), registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(registry.EXAMPLES))
def test_example(spark, duck, name):
    compare(spark, duck, *registry.EXAMPLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
