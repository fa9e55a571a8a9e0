"""Every query of the engine against its SQL."""

from pathlib import Path

import duckdb
import pytest

from siftwell.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sql, name):
    made = QUERIES[name](spark, str(DATA))
    columns = sorted(made.columns)
    expected = sql.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    rows = lambda found, names: sorted((tuple(r[names.index(c)] for c in columns) for r in found), key=repr)
    assert rows(made.collect(), made.columns) == rows(expected.fetchall(), expected.columns)


def test_order_of_the_queue(spark, sql):
    for name, order in (("review_queue", "ORDER BY priority, image_id"), ("review_page", "")):
        found = [(r["priority"], r["image_id"]) for r in QUERIES[name](spark, str(DATA)).collect()]
        expected = sql.sql(f"SELECT priority, image_id FROM ({ORACLES[name]}) {order}").fetchall()
        assert found == sorted(expected) and len(found) > 10
