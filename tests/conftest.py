import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-"), "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(SMALL)):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SMALL}/{name}'")
    return con


def _cell(v):
    if v is None or v != v:
        return "~"
    return repr(round(float(v), 9)) if hasattr(v, "__float__") and not isinstance(v, (str, bytes)) else str(v)


@pytest.fixture(scope="session")
def same_rows():
    def check(got, want):
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        rows = lambda df: sorted(tuple(map(_cell, r)) for r in df[cols].itertuples(index=False))
        assert rows(got.astype(object).where(got.notna(), None)) == rows(want.astype(object).where(want.notna(), None))

    return check
