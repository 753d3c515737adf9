"""Every registered query runs on the small tables and equals its SQL where it has one."""

import duckdb
import pytest

from entitymill.plans.catalogue import ORACLES, QUERIES
from entitymill.plans.registry import RAW
from tools.check import compare


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in RAW:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    message, _, good = compare(spark, con, name, sf_dir)
    # a result without rows is fine where the SQL has none either
    assert good, message


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
