from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.local.dir", work)
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"file://{work}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in Path(data).iterdir():
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    import decimal

    if isinstance(value, float):
        return round(value, 6)
    return float(value) if isinstance(value, decimal.Decimal) else value


def rows_of(columns, rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, and rows in an order that does not depend on the engine."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="session")
def same_rows(spark, duck, data):
    def check(query, sql: str) -> None:
        df = query(spark, data)
        wanted = duck.sql(sql)
        assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(wanted.columns, wanted.fetchall())

    return check
