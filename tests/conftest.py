import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("OPSLEDGER_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from opsledger.session import local_session

    s = local_session("*")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    yield s


@pytest.fixture(scope="session")
def ctx(spark):
    from opsledger.plans.context import Context

    return Context(spark, SF)


@pytest.fixture
def duck():
    """A DuckDB connection of the test's own, on one thread: an internal error in one statement makes
    its whole database unusable, which must not spread to other tests."""
    import duckdb

    from opsledger.sources.tables import DRIVER_TABLES

    con = duckdb.connect(config={"threads": 1})
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()
