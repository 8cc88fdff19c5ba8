"""Every registered query against its SQL on the smallest given tables, on each run of the tests."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from areapanel.catalog import registry  # noqa: E402
from tools.compare import TABLES, rows_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def database():
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test tables")
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    # Queries of the text folder without SQL are tested against brute force beside their operators.
    assert sorted(set(registry().queries) - set(SQL)) == ["s8_lineage"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    found = database.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())


def test_entry_and_lineage(spark, database):
    assert driver.entry(spark).count() == 150
    assert QUERIES["s8_lineage"](spark, SF_DIR).count() == len(TABLES)
