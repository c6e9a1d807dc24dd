import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def compare(spark, small):
    """Holds a query's rows against its SQL's in DuckDB."""
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")

    def plain(x):
        return "NULL" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x)

    def run(name):
        df = entry.queries()[name](spark, small)
        found = con.execute(entry.oracle_sql()[name])
        names = [c[0] for c in found.description]
        assert sorted(df.columns) == sorted(names)
        order = sorted(df.columns)
        ours = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
        theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall())
        assert ours == theirs

    return run
