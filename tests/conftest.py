import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from screensift.session import get_session

    s = get_session("local[4]", 8, extra={"spark.driver.memory": "8g"})
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from screensift.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con
