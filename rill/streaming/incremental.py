"""Streams that go on: several runs on one checkpoint, pane counts, update mode,
and rows that come too late.

* ``run_slices`` feeds a stream slice by slice, each slice one run of a new query
  on the same checkpoint: the offset log says which files are done, the state
  store holds the counts so far, and a slice that failed is run again.
* ``pane_counts`` and ``windows_from_panes``: a row is counted once, in a pane as
  long as window and slide have in common; a window's count is the one before it
  plus the panes that enter and less those that leave.
* ``UpdatedTops``: in update mode a batch holds the counts that changed.  They
  replace those in a table of counts, the changed windows alone are ranked, and
  only the partitions that they lie in are written anew.
* ``punctual``: the rows that are not behind the watermark, each once; the query's
  progress says how many were behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from rill.session import cut_lineage, release
from rill.streaming.trends import flat_windows, top_per_window


@dataclass
class Run:
    """One run of a query over the files that were there."""
    slice: int
    failed: bool
    batches: list[int]          # ids of the micro-batches that ended
    read: int                   # rows read
    late: int                   # rows behind the watermark, as the state operators report them


def run_slices(slices: Iterable[DataFrame], folder: str, stream: Callable[[], DataFrame], land: Callable[[DataFrame, int], None],
               checkpoint: str, output_mode: str = "append", attempts: int = 2) -> list[Run]:
    """Write each slice to ``folder`` and run ``stream()`` over what is new, with
    ``land`` as the callback of each micro-batch.  A run that fails is started
    again on the same checkpoint, ``attempts`` times in all; then its error is
    raised.  ``land`` sees a batch id again after a failure and has to replace
    what it wrote for it."""
    runs = []
    for number, rows in enumerate(slices):
        rows.write.mode("overwrite").parquet(f"{folder}/slice={number:06d}")
        for attempt in range(1, attempts + 1):
            query = (stream().writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
                     .foreachBatch(land).trigger(availableNow=True).start())
            try:
                query.awaitTermination()
                failed = False
            except StreamingQueryException:
                failed = True
                if attempt == attempts:
                    raise
            progress = query.recentProgress
            runs.append(Run(number, failed, [p["batchId"] for p in progress], sum(p["numInputRows"] for p in progress),
                            sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])))
            if not failed:
                break
    return runs


def sliced_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stream over the slices that ``run_slices`` writes."""
    return spark.readStream.schema(schema).parquet(f"{folder}/slice=*")


def replace_batch(sink: str, fn: Callable[[DataFrame], DataFrame] = lambda b: b) -> Callable[[DataFrame, int], None]:
    """Callback that lands a batch in a folder of its own; a replay replaces it."""
    return lambda batch, i: fn(batch).write.mode("overwrite").parquet(f"{sink}/batch={i}")


# ---- panes ----

def _common(window: int, slide: int) -> int:
    while slide:
        window, slide = slide, window % slide
    return window


def pane_counts(tags: DataFrame, window_s: int, slide_s: int, watermark: str | None = None) -> DataFrame:
    """``pane, word, cnt``: every row counted once, in the pane that it falls in."""
    t = tags.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    if watermark:
        t = t.withWatermark("timestamp", watermark)
    pane = F.window("timestamp", f"{_common(window_s, slide_s)} seconds")
    return t.groupBy(pane.alias("pane"), "word").agg(F.count(F.lit(1)).alias("cnt"))


def windows_from_panes(panes: DataFrame, window_s: int, slide_s: int) -> DataFrame:
    """Window counts from pane counts, by what enters and leaves.

    A pane's count enters with the first window that covers the pane and leaves
    with the first one after it that does not.  The sums of these steps, added up
    per word in order of time, are the counts; they hold until the next step.  Two
    rows per pane, whatever the ratio of window to slide; a group of the running
    sum has a row per step of a word, not per event."""
    length = _common(window_s, slide_s)
    at = F.unix_seconds(F.col("pane.start"))
    first = (F.ceil((at + length - window_s) / slide_s) * slide_s).cast("long")
    after = ((F.floor(at / slide_s) + 1) * slide_s).cast("long")
    steps = panes.select("word", F.explode(F.array(
        F.struct(first.alias("start"), F.col("cnt").alias("step")),
        F.struct(after.alias("start"), (-F.col("cnt")).alias("step")))).alias("s"))
    steps = steps.groupBy("word", "s.start").agg(F.sum("s.step").alias("step"))
    order = Window.partitionBy("word").orderBy("start")
    level = steps.select("word", "start", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("cnt"),
                         F.lead("start").over(order).alias("until")).where("cnt > 0")
    each = level.select("word", "cnt", F.explode(F.sequence("start", F.col("until") - slide_s, F.lit(slide_s).cast("long"))).alias("at"))
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return each.select(stamp(F.col("at")).alias("window_start"), stamp(F.col("at") + window_s).alias("window_end"), "word", "cnt")


def by_arrival(stream: DataFrame) -> DataFrame:
    """Rows stamped with the time of the batch that they arrive in, for windows on
    arrival time."""
    return stream.withColumn("timestamp", F.current_timestamp())


# ---- update mode ----

@dataclass
class UpdatedTops:
    """Callback for update mode: keeps ``counts`` and ``tops`` (folders) up to date.

    Both are partitioned by ``slot``, the window's beginning in the given format;
    a batch writes the slots that it changed and no others.  Counts of a batch are
    whole counts of their window and word, so a replay writes the same."""
    spark: SparkSession
    counts: str
    tops: str
    k: int = 30
    slot: str = "yyyy-MM-dd"

    COUNTS = "window_start timestamp_ntz, window_end timestamp_ntz, word string, cnt long, slot string"
    TOPS = "window_start timestamp_ntz, window_end timestamp_ntz, top string, slot string"

    def __post_init__(self) -> None:
        for path, schema in ((self.counts, self.COUNTS), (self.tops, self.TOPS)):
            self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy("slot").parquet(path)

    def _read(self, path: str, schema: str, slots: DataFrame) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path).join(slots, "slot", "left_semi")

    def _write(self, rows: DataFrame, path: str) -> None:
        (rows.repartition("slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("slot").parquet(path))

    def __call__(self, batch: DataFrame, _batch_id: int) -> None:
        changed = flat_windows(batch).withColumn("slot", F.date_format("window_start", self.slot))
        changed = cut_lineage(changed)
        slots = changed.select("slot").distinct()
        windows = changed.select("window_start", "window_end").distinct()
        same = ["window_start", "window_end", "word"]
        old = self._read(self.counts, self.COUNTS, slots).join(changed.select(*same), same, "left_anti")
        counts = cut_lineage(old.unionByName(changed))          # before its own source is written
        self._write(counts, self.counts)
        touched = counts.join(windows, ["window_start", "window_end"], "left_semi")
        ranked = top_per_window(touched, self.k).withColumn("slot", F.date_format("window_start", self.slot))
        others = self._read(self.tops, self.TOPS, slots).join(windows, ["window_start", "window_end"], "left_anti")
        tops = cut_lineage(others.unionByName(ranked))
        self._write(tops, self.tops)
        for used in (changed, counts, tops):
            release(used)

    def result(self) -> DataFrame:
        return self.spark.read.schema(self.TOPS).parquet(self.tops).drop("slot")


# ---- late rows ----

def punctual(rows: DataFrame, key: str, time_col: str, watermark: str) -> DataFrame:
    """The rows not behind the watermark, each key once.  The state operator
    counts what it drops row by row (an aggregate would count groups)."""
    t = rows.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    return t.dropDuplicates([key, time_col])
