"""Written tables lie in the shared folder; the package reaches the workers."""

from pyspark.sql import functions as F

from kinmark import session


def test_materialize_writes_into_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    df = session.materialize(spark.range(10).withColumn("x", F.col("id") % 3), "probe")
    assert df.count() == 10 and df.columns == ["id", "x"]
    assert all(f.startswith(base + "/kinmark/probe-") for f in df.inputFiles())
    assert session.materialize(spark.range(0), "empty").count() == 0


def test_only_the_columns_in_use_are_read(spark):
    df = session.materialize(spark.range(10).withColumn("x", F.lit("wide" * 50)), "pruned")
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_package_is_shipped_once(spark):
    session.ship(spark)
    session.ship(spark)
    assert sum(f.endswith("kinmark.zip") for f in spark.sparkContext._python_includes) == 1


def test_counters_fill_with_the_action(spark):
    df, seen = session.counted(spark.range(10), "run", even=F.col("id") % 2 == 0)
    assert df.count() == 10
    assert seen.get == {"rows": 10, "even": 5}
