"""Sliding hashtag trends with Structured Streaming.

* ``hashtags``: the per-line transformation (cut at the date marker, split
  on spaces, keep ``#`` words) -- the same function on batch or stream;
* ``sliding_counts``: event-time sliding windows with a watermark;
* ``top_per_window``: the per-window top-k list.  Ranking windows are not
  allowed on a stream, so it runs on each micro-batch's result inside
  ``foreachBatch`` (complete mode: the whole result table each time);
* ``run_available``: drive a stream over what is available now and land
  every batch in a parquet sink (overwrite for complete, append otherwise).

Parquet timestamps arrive as TIMESTAMP_NTZ; watermarks need TIMESTAMP, so
the event time is cast on the way in (session time zone UTC) and window
bounds are cast back to NTZ on the way out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rill.functions.text import hashtags as hashtag_words
from rill.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rill-{name}-{uuid.uuid4().hex}"


def hashtags(lines: DataFrame, value: str = "value", ts: str = "timestamp") -> DataFrame:
    """One row ``timestamp, word`` per hashtag of a line."""
    return lines.select(F.col(ts).alias("timestamp"),
                        F.explode(hashtag_words(value)).alias("word"))


def sliding_counts(tags: DataFrame, window: str = "5 minutes", slide: str = "2 minutes",
                   watermark: str | None = "5 minutes") -> DataFrame:
    """Count per (sliding event-time window, word).  With a slide longer
    than the window, rows between two windows are in none."""
    t = tags.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    if watermark:
        t = t.withWatermark("timestamp", watermark)
    if tags.sparkSession.sql(f"SELECT INTERVAL '{slide}' > INTERVAL '{window}'").first()[0]:
        # Spark's windows are no shorter than their slide: the first part of each slide
        end = F.col("window.start") + F.expr(f"INTERVAL '{window}'")
        t = t.withColumn("window", F.window("timestamp", slide)).where(F.col("timestamp") < end)
        counts = t.groupBy("window", "word").agg(F.count(F.lit(1)).alias("cnt"))
        return counts.select(F.struct(F.col("window.start").alias("start"), end.alias("end")).alias("window"), "word", "cnt")
    return (t.groupBy(F.window("timestamp", window, slide).alias("window"), "word")
            .agg(F.count(F.lit(1)).alias("cnt")))


def flat_windows(counts: DataFrame) -> DataFrame:
    """Window struct -> NTZ ``window_start, window_end`` columns."""
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                         "word", "cnt")


def top_per_window(counts: DataFrame, k: int = 30) -> DataFrame:
    """The ``k`` most frequent words of each window as one
    ``word:count`` list (count descending, then word)."""
    w = Window.partitionBy("window_start", "window_end").orderBy(F.col("cnt").desc(),
                                                               F.col("word").asc())
    ranked = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    entry = F.struct("rank", F.concat_ws(":", "word", F.col("cnt").cast("string")).alias("e"))
    return (ranked.groupBy("window_start", "window_end")
            .agg(F.array_sort(F.collect_list(entry)).alias("l"))
            .select("window_start", "window_end",
                    F.concat_ws(",", F.transform("l", lambda x: x["e"])).alias("top")))


def file_stream(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """A stream over the Parquet files at ``path`` (a file, a folder of parts or
    a pattern), ``files`` per micro-batch if given."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    # a pattern lets the source take a single file as well as a folder
    return reader.parquet(path if "[" in path or "*" in path else f"{path[:-1]}[{path[-1]}]")


def _lander(sink: str, output_mode: str,
            batch_fn: Callable[[DataFrame, int], DataFrame] | None):
    def land(batch: DataFrame, batch_id: int) -> None:
        out = batch_fn(batch, batch_id) if batch_fn else batch
        if output_mode == "complete":
            out.write.mode("overwrite").parquet(sink)
        else:
            out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return land


def start_stream(stream: DataFrame, sink: str, interval: str = "5 minutes",
                 output_mode: str = "complete",
                 batch_fn: Callable[[DataFrame, int], DataFrame] | None = None,
                 checkpoint: str | None = None):
    """R8 (live form): run ``stream`` on a processing-time trigger (a batch
    every ``interval``) into the same idempotent parquet sink as
    ``run_available``; returns the ``StreamingQuery`` to monitor or stop."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    return (stream.writeStream.outputMode(output_mode)
            .option("checkpointLocation", ckpt)
            .foreachBatch(_lander(sink, output_mode, batch_fn))
            .trigger(processingTime=interval)
            .start())


def run_available(stream: DataFrame, sink: str, output_mode: str = "complete",
                  batch_fn: Callable[[DataFrame, int], DataFrame] | None = None,
                  checkpoint: str | None = None) -> None:
    """Run ``stream`` over all data available now (``availableNow``) and land
    each micro-batch in parquet at ``sink``.

    In complete mode every batch holds the whole result and overwrites the
    sink; in append/update mode each batch overwrites its own ``batch=<id>``
    folder.  Either way a batch replayed after a failure replaces what it
    wrote before instead of duplicating it.  ``batch_fn`` maps a micro-batch
    before it is written (K8/X5: errors propagate and stop the query).
    Read the result with ``read_sink``.
    """
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (stream.writeStream.outputMode(output_mode)
         .option("checkpointLocation", ckpt)
         .foreachBatch(_lander(sink, output_mode, batch_fn))
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The rows ``run_available`` landed (without the batch folder column)."""
    df = spark.read.parquet(sink)
    return df.drop("batch") if "batch" in df.columns else df


def run_to_console(stream: DataFrame, output_mode: str = "complete", rows: int = 20) -> None:
    """K9: print each micro-batch (bounded to ``rows`` rows per batch)."""
    q = (stream.writeStream.outputMode(output_mode).format("console")
         .option("numRows", rows).option("truncate", False)
         .trigger(availableNow=True).start())
    q.awaitTermination()
