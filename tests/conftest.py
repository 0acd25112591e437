"""One Spark session for all tests."""

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{folder}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    if isinstance(value, list):
        return [plain(x) for x in value]
    return value


@pytest.fixture(scope="session")
def same_rows(spark, duck, sf_dir):
    """Run a query and its SQL and compare columns and rows."""

    def compare(query, sql):
        frame = query(spark, sf_dir)
        found = duck.sql(sql)
        columns = sorted(frame.columns)
        assert columns == sorted(found.columns)
        at = [found.columns.index(c) for c in columns]
        ours = sorted(([plain(row[c]) for c in columns] for row in frame.collect()), key=repr)
        theirs = sorted(([plain(row[i]) for i in at] for row in found.fetchall()), key=repr)
        assert ours == theirs

    return compare
