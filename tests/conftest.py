import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_ORACLE}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    """Compares a query with its oracle: columns by name, rows as a bag, doubles to nine digits."""

    def cell(v):
        if isinstance(v, float):
            return "nan" if v != v else f"{v:.9g}"
        if isinstance(v, (list, tuple)):
            return [cell(x) for x in v]
        return v

    def run(query, sql):
        got = query(spark, SF_ORACLE)
        cols = sorted(got.columns)
        left = sorted((repr([cell(x) for x in r]) for r in got.select(*cols).collect()))
        res = duck.execute(sql)
        names = [c[0] for c in res.description]
        assert sorted(names) == cols
        right = sorted(repr([cell(r[names.index(c)]) for c in cols]) for r in res.fetchall())
        assert left == right

    return run
