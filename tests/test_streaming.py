from __future__ import annotations

import datetime as dt

from stenograph.streaming.arrivals import append_once, arriving, words_by_window

SCHEMA = "country string, opened_at timestamp, text string"


def test_append_once_and_windows(spark, tmp_path):
    t = dt.datetime(2020, 1, 1, 10)
    spark.createDataFrame([("ES", t, "uno dos"), ("PT", None, "três"), ("ES", t + dt.timedelta(hours=2), None)], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = arriving(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    for _ in range(2):  # a second run finds nothing new
        append_once(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    q = words_by_window(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [tuple(r)[1:] for r in spark.sql("SELECT * FROM w").collect()] == [("ES", 2, 2)]
