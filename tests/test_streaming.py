"""Streams over a file source equal the batch answer; late rows; errors."""

import pytest
from pyspark.sql import functions as F

from rill.plans import datasets as ds
from rill.sources.files import kafka_lines, kafka_stream
from rill.streaming.trends import (flat_windows, hashtags, read_sink, run_available,
                                   scratch_path, sliding_counts)
from conftest import SF_SMALL


def write_in_time_order(df, ts, folder):
    """Fixture: one file per day, oldest first."""
    day = F.to_date(F.col(ts))
    for i, (d,) in enumerate(df.select(day.alias("d")).distinct().orderBy("d").collect()):
        df.where(day == F.lit(d)).coalesce(1).write.parquet(f"{folder}/part-{i:06d}")


def _batch_answer(spark):
    return flat_windows(sliding_counts(hashtags(ds.tweets(spark, SF_SMALL)), watermark=None))


def _stream(spark, folder, schema, files=2):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/part-*")


def test_stream_complete_equals_batch(spark):
    tw = ds.tweets(spark, SF_SMALL)
    folder = scratch_path(spark, "t")
    write_in_time_order(tw, "timestamp", folder)
    sink = scratch_path(spark, "s")
    counts = sliding_counts(hashtags(_stream(spark, folder, tw.schema)))
    run_available(counts, sink, "complete", batch_fn=lambda b, _i: flat_windows(b))
    got = read_sink(spark, sink)
    want = _batch_answer(spark)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_late_rows_append_drops_complete_keeps(spark):
    tw = ds.tweets(spark, SF_SMALL)
    folder = scratch_path(spark, "late")
    # files in reverse time order: after the first file every older row is late
    days = [r[0] for r in tw.select(F.to_date("timestamp")).distinct().orderBy(F.col("to_date(timestamp)").desc()).collect()]
    for i, d in enumerate(days):
        tw.where(F.to_date("timestamp") == F.lit(d)).coalesce(1).write.parquet(f"{folder}/part-{i:06d}")
    results = {}
    for mode in ("append", "complete"):
        sink = scratch_path(spark, mode)
        counts = sliding_counts(hashtags(_stream(spark, folder, tw.schema, files=1)))
        run_available(counts, sink, mode, batch_fn=lambda b, _i: flat_windows(b))
        results[mode] = read_sink(spark, sink).count()
    assert results["complete"] == _batch_answer(spark).count()
    assert results["append"] < results["complete"]


def test_failing_batch_function_stops_the_query(spark):
    tw = ds.tweets(spark, SF_SMALL)
    folder = scratch_path(spark, "err")
    write_in_time_order(tw, "timestamp", folder)

    def boom(_b, _i):
        raise ValueError("bad batch")

    with pytest.raises(Exception):
        run_available(_stream(spark, folder, tw.schema), scratch_path(spark, "s"), "append",
                      batch_fn=boom)


def test_kafka_reader_options(spark):
    # the connector is absent here, so loading fails on the format, not before
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "broker:9092", "topic-a").load()
    raw = spark.createDataFrame([("2021-01-01 00:00:00", b"#a x,2021", 0, 5)],
                                "timestamp string, value binary, partition int, offset long")
    row = kafka_lines(raw).first()
    assert row.value == "#a x,2021" and row.offset == 5


def test_memory_sink_read_by_sql(spark):
    tw = ds.tweets(spark, SF_SMALL)
    folder = scratch_path(spark, "mem")
    write_in_time_order(tw, "timestamp", folder)
    counts = sliding_counts(hashtags(_stream(spark, folder, tw.schema)))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("seen_tags")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT COUNT(*) AS n FROM seen_tags").first().n == _batch_answer(spark).count()


def test_live_trigger_and_console(spark):
    from rill.streaming.trends import run_to_console, start_stream

    tw = ds.tweets(spark, SF_SMALL)
    folder = scratch_path(spark, "live")
    write_in_time_order(tw, "timestamp", folder)
    sink = scratch_path(spark, "s")
    counts = sliding_counts(hashtags(_stream(spark, folder, tw.schema)))
    q = start_stream(counts, sink, "1 second", batch_fn=lambda b, _i: flat_windows(b))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_sink(spark, sink).count() == _batch_answer(spark).count()
    run_to_console(hashtags(_stream(spark, folder, tw.schema)), "append", rows=2)
