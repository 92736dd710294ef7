import os
import sys
import tempfile
from pathlib import Path

import pytest
from helpers import ROOT, SMALL

sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", scratch).config("spark.sql.warehouse.dir", f"{scratch}/warehouse").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con
