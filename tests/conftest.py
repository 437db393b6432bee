import glob
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("SKERRY_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from skerry.session import session

    s = session(
        f"local[{os.environ.get('SKERRY_TEST_CPUS', '4')}]", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__local__dir=tempfile.mkdtemp(prefix="spark-", dir="/tmp"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="warehouse-"), spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="checkpoint-"),
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(s.conf.get("spark.checkpoint.dir"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def shown(v):
    """A value as text that both engines share."""
    if v is None:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(shown, v)) + "]"
    return str(v)


@pytest.fixture(scope="session")
def same(duck):
    """Asserts that a DataFrame and a DuckDB query have the same columns and rows."""

    def check(df, sql):
        cursor = duck.execute(sql)
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        columns = sorted(names)
        left = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
        right = sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
        assert len(left) == len(right)
        assert left == right

    return check
