"""Streams over several runs: restart, panes, update mode, late rows."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rill.streaming import incremental as inc
from rill.streaming.trends import flat_windows, sliding_counts, top_per_window

SCHEMA = "id long, timestamp timestamp, word string"
START = dt.datetime(2024, 1, 1)


def rows(n=300, days=4, seed=1):
    rng = random.Random(seed)
    return [(i, START + dt.timedelta(seconds=rng.randrange(days * 86400)), rng.choice("abcde")) for i in range(n)]


def slices(spark, data, days=4):
    edge = lambda d: START + dt.timedelta(days=d)
    return [spark.createDataFrame([r for r in data if edge(d) <= r[1] < edge(d + 1)], SCHEMA) for d in range(days)]


def plain(spark, data, window="5 minutes", slide="2 minutes"):
    got = flat_windows(sliding_counts(spark.createDataFrame(data, SCHEMA), window, slide, None))
    return sorted(map(tuple, got.collect()))


def test_restart_from_checkpoint(spark, tmp_dir):
    data, seen = rows(), []

    def land(batch, i):
        seen.append(i)
        if i == 1 and seen.count(1) == 1:
            raise RuntimeError("lost")
        flat_windows(batch).write.mode("overwrite").parquet(f"{tmp_dir}/sink")

    runs = inc.run_slices(slices(spark, data), f"{tmp_dir}/in",
                          lambda: sliding_counts(inc.sliced_stream(spark, f"{tmp_dir}/in", SCHEMA)), land, f"{tmp_dir}/ckpt", "complete")
    assert [(r.slice, r.failed) for r in runs] == [(0, False), (1, True), (1, False), (2, False), (3, False)]
    assert seen == [0, 1, 1, 2, 3]                  # the failed batch again, no earlier one
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/sink").collect())) == plain(spark, data)


def test_a_batch_that_always_fails_ends_the_run(spark, tmp_dir):
    def land(_batch, _i):
        raise RuntimeError("always")

    with pytest.raises(StreamingQueryException):
        inc.run_slices(slices(spark, rows(20)), f"{tmp_dir}/in", lambda: inc.sliced_stream(spark, f"{tmp_dir}/in", SCHEMA),
                       land, f"{tmp_dir}/ckpt")


@pytest.mark.parametrize(("window", "slide"), [(300, 120), (30, 10), (60, 60), (60, 90), (3600, 60)])
def test_windows_from_panes(spark, window, slide):
    rng = random.Random(window)
    data = [(i, START + dt.timedelta(seconds=rng.randrange(4000)), rng.choice("ab")) for i in range(150)]
    panes = inc.pane_counts(spark.createDataFrame(data, SCHEMA), window, slide)
    assert panes.agg(F.sum("cnt")).first()[0] == len(data)             # each row once
    got = inc.windows_from_panes(panes, window, slide)
    assert sorted(map(tuple, got.collect())) == plain(spark, data, f"{window} seconds", f"{slide} seconds")


def test_windows_by_arrival(spark, tmp_dir):
    """All rows of a batch arrive at one time, whatever they say."""
    landed = []
    stream = lambda: inc.pane_counts(inc.by_arrival(inc.sliced_stream(spark, f"{tmp_dir}/in", SCHEMA)), 300, 120, "5 minutes")
    inc.run_slices([spark.createDataFrame(rows(50), SCHEMA)], f"{tmp_dir}/in", stream,
                   lambda b, _i: landed.extend(b.collect()), f"{tmp_dir}/ckpt", "update")
    assert len({r.pane for r in landed}) == 1 and sum(r.cnt for r in landed) == 50
    assert abs((landed[0].pane.start - dt.datetime.now()).total_seconds()) < 86400


def test_update_mode_writes_changed_slots_only(spark, tmp_dir):
    data = rows(400, 4)
    tops = inc.UpdatedTops(spark, f"{tmp_dir}/counts", f"{tmp_dir}/tops", 2)
    states = []

    def land(batch, i):
        tops(batch, i)
        tops(batch, i)                              # a replay changes nothing
        files = spark.read.schema(tops.TOPS).parquet(tops.tops).select("slot", F.input_file_name().alias("f"))
        states.append({r.slot: set(r.f) for r in files.groupBy("slot").agg(F.collect_set("f").alias("f")).collect()})

    inc.run_slices(slices(spark, data), f"{tmp_dir}/in",
                   lambda: sliding_counts(inc.sliced_stream(spark, f"{tmp_dir}/in", SCHEMA)), land, f"{tmp_dir}/ckpt", "update")
    assert len(states) >= 4
    for before, after in zip(states, states[1:]):
        last = max(before)                          # windows over midnight touch the day before
        assert all(after[s] == before[s] for s in before if s < last)
    want = top_per_window(flat_windows(sliding_counts(spark.createDataFrame(data, SCHEMA), watermark=None)), 2)
    assert sorted(map(tuple, tops.result().collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_accounted_for(spark, tmp_dir):
    data = rows(200, 4)
    parts = slices(spark, data)
    again = parts[0].limit(5)                       # keys that came before
    order = [parts[0], parts[3], parts[2].union(again), parts[1]]
    runs = inc.run_slices(order, f"{tmp_dir}/in",
                          lambda: inc.punctual(inc.sliced_stream(spark, f"{tmp_dir}/in", SCHEMA), "id", "timestamp", "36 hours"),
                          inc.replace_batch(f"{tmp_dir}/sink"), f"{tmp_dir}/ckpt")
    kept = spark.read.parquet(f"{tmp_dir}/sink")
    mark = max(r[1] for r in data if r[1] >= START + dt.timedelta(days=3)) - dt.timedelta(hours=36)
    late = [r for r in data if START + dt.timedelta(days=1) <= r[1] < START + dt.timedelta(days=3) and r[1] <= mark]
    assert sum(r.read for r in runs) == 205 and sum(r.late for r in runs) == len(late) + 5
    assert kept.count() == kept.select("id").distinct().count() == 200 - len(late)
