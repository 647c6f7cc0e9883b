"""Streaming trend queries over the given ``events`` files, read by a file
source with ``availableNow``.  The results do not depend on how the source
cuts its files into micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from rill.plans import datasets as ds
from rill.plans.registry import query
from rill.streaming.incremental import (UpdatedTops, pane_counts, punctual, replace_batch, run_slices, sliced_stream,
                                        windows_from_panes)
from rill.streaming.trends import (file_stream, flat_windows, hashtags, read_sink, run_available,
                                   scratch_path, sliding_counts, top_per_window)
from rill.sources.tables import table

# Fixed value: the length of the trend list.
TOP_K = 30
#: Rows of the sorted report.
REPORT = 100

# ---- oracle building blocks (DuckDB) ----
_TAGS = """t AS (SELECT ts, w FROM (
  SELECT ts, unnest(string_split(split_part(concat('#', event_type, ' user', user_id, ',2021-01-01'),
                                             ',2021', 1), ' ')) AS w FROM events)
  WHERE starts_with(w, '#'))"""


def _windows_sql(size_s: int, slide_s: int) -> str:
    size, slide = size_s * 1_000_000, slide_s * 1_000_000
    n = -(-size_s // slide_s)
    ks = ", ".join(f"({k})" for k in range(n))
    return f"""{_TAGS},
s AS (SELECT w, epoch_us(ts) AS us, (epoch_us(ts) // {slide}) * {slide} AS b FROM t),
x AS (SELECT w, b - k * {slide} AS st FROM s, (VALUES {ks}) v(k) WHERE us < b - k * {slide} + {size}),
c AS (SELECT make_timestamp(st) AS window_start, make_timestamp(st + {size}) AS window_end,
             w AS word, COUNT(*) AS cnt FROM x GROUP BY ALL)"""


def _tweet_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return ds.tweet_lines(file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", schema))


def _sliding(spark, sf_dir, window, slide, mode="complete", fn=None):
    counts = sliding_counts(hashtags(_tweet_stream(spark, sf_dir)), window, slide, "5 minutes")
    sink = scratch_path(spark, "sink")
    run_available(counts, sink, mode, batch_fn=fn or (lambda b, _i: flat_windows(b)))
    return read_sink(spark, sink)


@query("stream_sliding_counts", sql="WITH " + _windows_sql(300, 120) + " SELECT * FROM c")
def stream_sliding_counts(spark, sf_dir):
    """Hashtag counts per 5-minute window sliding by 2
    minutes on event time, 5-minute watermark, complete mode."""
    return _sliding(spark, sf_dir, "5 minutes", "2 minutes")


@query("stream_sliding_counts_short", sql="WITH " + _windows_sql(30, 10) + " SELECT * FROM c")
def stream_sliding_counts_short(spark, sf_dir):
    """R2: the same with 30-second windows sliding by 10 seconds."""
    return _sliding(spark, sf_dir, "30 seconds", "10 seconds")


@query("stream_top_per_window", sql="WITH " + _windows_sql(300, 120) + f""",
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, window_end
                                   ORDER BY cnt DESC, word ASC) AS rk FROM c)
SELECT window_start, window_end, string_agg(word || ':' || cnt, ',' ORDER BY rk) AS top
FROM r WHERE rk <= {TOP_K} GROUP BY window_start, window_end
""")
def stream_top_per_window(spark, sf_dir):
    """The top hashtags of every window as one
    ``word:count`` list, ranked inside ``foreachBatch`` because ranking
    windows are refused on streams."""
    return _sliding(spark, sf_dir, "5 minutes", "2 minutes",
                    fn=lambda b, _i: top_per_window(flat_windows(b), TOP_K))


@query("stream_closed_windows", sql="WITH " + _windows_sql(300, 120) + """
SELECT * FROM c WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 5 MINUTE
""")
def stream_closed_windows(spark, sf_dir):
    """Append mode -- a window is emitted once the watermark (max
    event time minus 5 minutes) passes its end, so only closed windows
    appear and the state of older windows is dropped."""
    return _sliding(spark, sf_dir, "5 minutes", "2 minutes", mode="append")


@query("stream_tag_extract", sql=f"WITH {_TAGS} SELECT ts AS timestamp, w AS word FROM t")
def stream_tag_extract(spark, sf_dir):
    """Hashtags of every tweet line (the stream's
    per-line transformation, run as a batch)."""
    return hashtags(ds.tweets(spark, sf_dir))


@query("stream_sorted_report", sql="WITH " + _windows_sql(300, 120) + f"""
SELECT * FROM c ORDER BY window_start ASC, cnt DESC, word ASC LIMIT {REPORT}
""")
def stream_sorted_report(spark, sf_dir):
    """The stream's result in complete mode, ordered by window and by
    falling count inside the stream's own plan; its first rows."""
    counts = sliding_counts(hashtags(_tweet_stream(spark, sf_dir)))
    ordered = counts.orderBy(F.col("window").asc(), F.col("cnt").desc(), F.col("word").asc()).limit(REPORT)
    sink = scratch_path(spark, "sink")
    run_available(ordered, sink, "complete", batch_fn=lambda b, _i: flat_windows(b))
    return read_sink(spark, sink)


@query("stream_batch_counts", sql="""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS rows FROM events GROUP BY 1
""")
def stream_batch_counts(spark, sf_dir):
    """A per-batch callback over the raw stream: every micro-batch
    reports its rows per day, and the reports are summed."""
    sink = scratch_path(spark, "sink")

    def report(batch, _batch_id):
        day = F.date_format(F.to_date(F.col("timestamp")), "yyyy-MM-dd").alias("day")
        return batch.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))

    run_available(_tweet_stream(spark, sf_dir), sink, "append", batch_fn=report)
    return read_sink(spark, sink).groupBy("day").agg(F.sum("rows").alias("rows"))


# ---- streams that go on ----

@query("stream_restart_counts", sql="WITH " + _windows_sql(300, 120) + """
SELECT *, CAST(6 AS INTEGER) AS runs, CAST(1 AS INTEGER) AS failed FROM c""")
def stream_restart_counts(spark, sf_dir):
    """The sliding counts of ``events`` in five slices, each a new query on
    the same checkpoint.  The callback of the third batch fails once; the query
    started after it replays the batch from the offset log and goes on from the
    stored counts.  Same rows as in one run."""
    folder, sink, checkpoint = (scratch_path(spark, n) for n in ("slices", "sink", "checkpoint"))
    schema = table(spark, sf_dir, "events").schema
    failures = []

    def land(batch, batch_id):
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("stopped in the middle of a batch")
        flat_windows(batch).write.mode("overwrite").parquet(sink)

    runs = run_slices(ds.event_slices(spark, sf_dir), folder,
                      lambda: sliding_counts(hashtags(ds.tweet_lines(sliced_stream(spark, folder, schema)))),
                      land, checkpoint, "complete")
    return (read_sink(spark, sink).withColumn("runs", F.lit(len(runs)))
            .withColumn("failed", F.lit(sum(r.failed for r in runs))))


@query("stream_pane_counts", sql="WITH " + _windows_sql(300, 120) + " SELECT * FROM c")
def stream_pane_counts(spark, sf_dir):
    """The same windows from panes of one minute: a row is counted once and
    a window is the one before it plus what enters, less what leaves."""
    sink = scratch_path(spark, "sink")
    panes = pane_counts(hashtags(_tweet_stream(spark, sf_dir)), 300, 120, "5 minutes")
    run_available(panes, sink, "complete", batch_fn=lambda b, _i: windows_from_panes(b, 300, 120))
    return read_sink(spark, sink)


@query("stream_top_updated", sql="WITH " + _windows_sql(300, 120) + f""",
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, window_end
                                   ORDER BY cnt DESC, word ASC) AS rk FROM c)
SELECT window_start, window_end, string_agg(word || ':' || cnt, ',' ORDER BY rk) AS top
FROM r WHERE rk <= {TOP_K} GROUP BY window_start, window_end
""")
def stream_top_updated(spark, sf_dir):
    """The top list per window in update mode over five slices: a batch
    ranks the windows that it changed and replaces their days in the sink."""
    folder, counts, tops, checkpoint = (scratch_path(spark, n) for n in ("slices", "counts", "tops", "checkpoint"))
    schema = table(spark, sf_dir, "events").schema
    sink = UpdatedTops(spark, counts, tops, TOP_K)
    run_slices(ds.event_slices(spark, sf_dir), folder,
               lambda: sliding_counts(hashtags(ds.tweet_lines(sliced_stream(spark, folder, schema)))),
               sink, checkpoint, "update")
    return sink.result()


#: Order in which the slices arrive, and how far the watermark lies behind the latest row.
LATE_ORDER = (0, 2, 1, 4, 3)
LATE_DAYS = 8


def _late_sql() -> str:
    days = ds.SLICE_DAYS
    case = " ".join(f"WHEN ts >= TIMESTAMP '{ds.ACTIVITY_EPOCH}' + INTERVAL {d} DAY THEN {LATE_ORDER.index(i)}"
                    for i, d in reversed(list(enumerate(days))) if i)
    return f"""
WITH e AS (SELECT event_id, ts, CASE {case} ELSE {LATE_ORDER.index(0)} END AS pos FROM events),
p AS (SELECT DISTINCT pos FROM e),
w AS (SELECT p.pos, date_trunc('millisecond', MAX(e.ts)) - INTERVAL {LATE_DAYS} DAY AS mark
      FROM p LEFT JOIN e ON e.pos < p.pos GROUP BY p.pos),
l AS (SELECT e.*, w.mark IS NOT NULL AND e.ts <= w.mark AS late FROM e JOIN w USING (pos))
SELECT CAST(pos AS BIGINT) AS run, COUNT(*) AS read, COUNT(*) FILTER (WHERE late) AS late,
       COUNT(DISTINCT (event_id, ts)) FILTER (WHERE NOT late) AS kept
FROM l GROUP BY pos"""


@query("stream_late_rows", sql=_late_sql())
def stream_late_rows(spark, sf_dir):
    """Slices that arrive out of order: rows read, dropped behind the
    watermark (as the query's progress reports them) and kept, per run."""
    folder, sink, checkpoint = (scratch_path(spark, n) for n in ("slices", "sink", "checkpoint"))
    schema = table(spark, sf_dir, "events").schema
    runs = run_slices(ds.event_slices(spark, sf_dir, LATE_ORDER), folder,
                      lambda: punctual(sliced_stream(spark, folder, schema), "event_id", "ts", f"{LATE_DAYS} days")
                      .select("event_id", "ts"), replace_batch(sink), checkpoint)
    # one row per run and batch: as many as there are slices
    batches = spark.createDataFrame([(r.slice, i) for r in runs for i in r.batches], "run long, batch int")
    told = spark.createDataFrame([(r.slice, r.read, r.late) for r in runs], "run long, read long, late long")
    kept = spark.read.schema("event_id long, ts timestamp, batch int").parquet(sink).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"))
    kept = batches.join(kept, "batch", "left").groupBy("run").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))
    return told.join(kept, "run").select("run", "read", "late", "kept")
