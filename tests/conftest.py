import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sparkprep.session import tuned

    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    session = tuned(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("a int, b string", (1, "x"), ...)``"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]
