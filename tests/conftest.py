import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{ROOT}/tests:{ROOT}/tests/llm:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if (SF / f"{table}.parquet").exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return db


def plain(value):
    return str(value) if isinstance(value, float) else value


@pytest.fixture
def same(spark, duck):
    """Asserts that a query and its SQL return the same columns and rows."""

    def check(query, sql):
        df = query(spark, str(SF))
        columns = sorted(df.columns)
        cursor = duck.execute(sql)
        names = [x[0] for x in cursor.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        expected = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
        got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
        assert len(got) == len(expected)
        assert got == expected

    return check
