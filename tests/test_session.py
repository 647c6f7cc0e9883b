"""Lineage cuts go to the session's checkpoint folder and can be released."""

import os

from rill.session import cut_lineage, ensure_checkpoint_dir, loop_partitions, release


def test_cut_lands_in_checkpoint_folder_and_is_released(spark):
    # the context keeps its checkpoints in a subfolder of the configured one
    configured = spark.conf.get("spark.checkpoint.dir").replace("file:", "").rstrip("/")
    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    assert folder.startswith(configured)
    cut = cut_lineage(spark.range(100).withColumnRenamed("id", "v"))
    local = cut._rill_cut.replace("file:", "")
    assert local.startswith(configured) and os.path.isdir(local)
    assert cut.count() == 100
    release(cut)
    assert not os.path.exists(local)
    release(cut)                       # a second release is a no-op
    release(spark.range(3))            # DataFrames that are not cuts are left alone


def test_loop_partitions_follow_the_setting(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("100000", "3"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert loop_partitions(spark) == int(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
