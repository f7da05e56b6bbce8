"""Incremental processing reads each file once."""

import datetime

from kinmark.streaming.incremental import postprocess, process_available, windowed_arrivals


def test_available_now(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.range(3).write.mode("append").parquet(src)
    run = lambda: process_available(spark, src, "id bigint", lambda d: d.selectExpr("id + 1 AS id"), out, cp).awaitTermination()
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    spark.range(10, 12).write.mode("append").parquet(src)
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 11, 12]


def test_arrivals(spark, tmp_path):
    day = datetime.datetime(2020, 1, 1)
    df = spark.createDataFrame([("a", day), ("a", day + datetime.timedelta(1)), ("b", None)], "collection_id string, created_at timestamp")
    assert [(r.collection_id, r.n) for r in windowed_arrivals(df).collect()] == [("a", 2)]
    df.where("created_at is not null").write.parquet(str(tmp_path / "e"))
    stream = windowed_arrivals(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("arrivals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.n for r in spark.sql("select * from arrivals").collect()] == [2]


def test_postprocess(spark):
    g = spark.createDataFrame([(1, "person"), (2, "invalid"), (3, None), (4, "family")], "id bigint, g_type string")
    assert [r.id for r in postprocess(g, lambda d: d.select("id"), 1, 3).collect()] == [1, 3]
