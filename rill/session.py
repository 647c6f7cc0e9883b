"""Session construction and lineage-cut helpers.

Everything here is ordinary SparkSession configuration.  The library never
hard-codes a cluster path: the checkpoint folder comes from the session's
``spark.checkpoint.dir``; only a local (test) session without that setting
gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query in the library is written against.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "rill", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:                  # else the cluster's own setting
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("RILL_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Session-level settings can be changed on a reused session too.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    *and* the master is local (tests, laptops) is a private scratch folder
    used; on a cluster an unset value is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a "
                "shared (fault-tolerant) folder to cut lineage")
        configured = tempfile.mkdtemp(prefix="rill-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def loop_partitions(spark: SparkSession) -> int:
    """Partition count of the fixed side of a loop: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame, tidy: bool = False) -> DataFrame:
    """Materialise ``df`` as parquet in the shared checkpoint folder and
    return a DataFrame that starts from those files.

    One job writes the rows (``Dataset.checkpoint`` would compute the plan
    twice unless cached); the files live in the fault-tolerant shared folder,
    so losing an executor never forces a replay of earlier loop rounds.  With ``tidy``
    the write's own shuffle files are deleted as soon as it is done.
    """
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{folder}/rill-cut-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    if tidy:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        if tidy and before is None:
            spark.conf.unset(_CLEANUP)
        elif tidy:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)      # known, so no job reads footers
    out._rill_cut = path          # lets ``release`` delete the files later
    return out


def store_bucketed(df: DataFrame, keys: str | list[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` in the shared
    checkpoint folder and return it.

    A join or aggregate on exactly these keys reads the buckets as they lie, so
    a loop shuffles its large fixed side once, when it is stored, and only its
    small side in every round.  ``buckets`` defaults to the session's shuffle
    partitions, which the other side of a join then has, too.  The rows are dealt
    by the hash that bucketing uses, so each bucket is one file."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"rill_bucketed_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    (df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    out = spark.table(name)
    out._rill_cut, out._rill_table = path, name
    return out


def release(df: DataFrame | None) -> None:
    """Delete the files behind a DataFrame returned by ``cut_lineage`` or
    ``store_bucketed`` once nothing reads it any more (loops call this for the
    previous round's state after the next one is written, so the shared folder
    does not fill up with one copy of the state per round).  Other DataFrames are
    left alone."""
    path = getattr(df, "_rill_cut", None) if df is not None else None
    if not path:
        return
    if getattr(df, "_rill_table", None):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._rill_table}")
        df._rill_table = None
    jvm = df.sparkSession._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    fs.delete(hpath, True)
    df._rill_cut = None
