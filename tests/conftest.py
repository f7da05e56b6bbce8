"""One small local session for all tests."""

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over literal arguments."""
    from pyspark.sql import functions as F

    def value(f, *args, **kwargs):
        cols = [F.lit(a) for a in args]
        return spark.range(1).select(f(*cols, **kwargs).alias("v")).first().v

    return value
