"""Keyed-table operations (a wide-column table re-aimed as DataFrames):
row keys, key-range regions, upsert, get, scans and deletes.

Writes are batch operations over whole DataFrames -- an upsert is one
aggregation keyed on the row key, a delete one anti join -- never a loop
of single-row puts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.operators.sorting import add_row_index
from rill.session import cut_lineage, release

# The pre-split points of the keyed table (byte order).
DEFAULT_SPLITS = ("20", "40", "60")


def with_row_keys(df: DataFrame, order, key: str = "row_key", partitions: int | None = None,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """String row keys ``'0' .. str(n-1)`` following a total ``order``
    (``partitions`` and ``keep`` as in ``add_row_index``)."""
    return add_row_index(df, order, "__ix", partitions, keep).withColumn(key, F.col("__ix").cast("string")).drop("__ix")


def key_region(key: str | Column, splits: Sequence[str] = DEFAULT_SPLITS) -> Column:
    """Y2: region number of a string key for pre-split points in byte order
    (keys below the first split go to region 0, ... , keys at or above the
    last split to region ``len(splits)``)."""
    k = F.col(key) if isinstance(key, str) else key
    expr = F.lit(len(splits))
    for i in reversed(range(len(splits))):
        expr = F.when(k < F.lit(splits[i]), F.lit(i)).otherwise(expr)
    return expr


def bulk_load_layout(df: DataFrame, key: str, splits: Sequence[str] = DEFAULT_SPLITS,
                     partitions: int | None = None) -> DataFrame:
    """Rows in key order, range partitioned, so that a region of any size
    is spread over as many tasks as its rows need and each task writes one
    sorted run (regions are ranges of keys, so their order is that of keys)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key_region(key, splits), key).sortWithinPartitions(key)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """The table's columns and their types."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def upsert(base: DataFrame, changes: DataFrame, key: str = "row_key", version: str | None = None) -> DataFrame:
    """Put cells -- insert new keys, overwrite existing ones.

    Columns missing from ``changes`` keep the base value (a put names only
    the cells it writes).  ``version`` names a column of ``changes`` that orders
    its puts: per cell the put of the highest version wins, of equal ones the
    one whose value sorts last, so the result does not depend on the order of
    rows.  Every put is newer than the base.  The choice is a ``max_by``
    aggregate: the puts of a key are combined map-side first, then meet its base
    rows.  Keys of the base seldom repeat, so its rows are shuffled as they are
    and only then given what the aggregate compares.
    """
    value_cols = [c for c in base.columns if c != key]
    put_cols = [c for c in value_cols if c in changes.columns]
    at = F.col(version).cast("long") if version else F.lit(None).cast("long")
    wrote = lambda c, v: F.struct(v.alias("v"), F.col(c).cast("string").alias("tie"))
    # the winning put of each cell with its version
    puts = changes.groupBy(key).agg(F.max(F.lit(1)).alias("__put"), *[F.max_by(F.struct(F.col(c).alias("x"), at.alias("v")), wrote(c, at)).alias(c) for c in put_cols])
    puts = puts.select(key, *[(F.col(c)["x"] if c in put_cols else F.lit(None).cast(base.schema[c].dataType)).alias(c)
                              for c in value_cols], "__put")
    rows = base.select(key, *value_cols, F.lit(0).alias("__put")).unionByName(puts).repartition(F.col(key))
    newest = lambda c: F.struct(F.col("__put"), F.col(c).cast("string").alias("tie"))
    return rows.groupBy(key).agg(*[
        F.max_by(c, newest(c) if c in put_cols else F.when(F.col("__put") == 0, newest(c))).alias(c) for c in value_cols])


def get(table: DataFrame, key_value: str, key: str = "row_key") -> DataFrame:
    """All cells of one row (a pushed-down equality filter)."""
    return table.where(F.col(key) == F.lit(key_value))


def delete_keys(table: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    """Delete whole rows for a set of keys (one anti join)."""
    return table.join(keys.select(key).distinct(), key, "left_anti")


@dataclass
class RegionTable:
    """A keyed table in a folder, partitioned by key region.

    A batch of puts or deletes reads and writes the regions that its keys fall
    into and leaves the files of all others alone; a get reads one region.  The
    split points are the table's own and should grow with it, since a region is
    what a put rewrites.  Rows of a region lie in key order, in as many files as
    its share of the rows asks for."""
    spark: SparkSession
    path: str
    key: str = "row_key"
    splits: Sequence[str] = field(default=DEFAULT_SPLITS)

    def _write(self, rows: DataFrame, dynamic: bool) -> None:
        rows = rows.withColumn("region", key_region(self.key, self.splits))
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(n, "region", self.key).sortWithinPartitions("region", self.key)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
         .partitionBy("region").parquet(self.path))

    def load(self, rows: DataFrame) -> None:
        """The whole table, replacing what is there."""
        self._write(rows, dynamic=False)

    def read(self) -> DataFrame:
        """All rows with their region."""
        return self.spark.read.parquet(self.path)

    def _regions(self, keys: DataFrame) -> list[int]:
        """Regions of the keys: as many as there are split points, at most one more."""
        return [r[0] for r in keys.select(key_region(self.key, self.splits).alias("r")).distinct().collect()]

    def _replace(self, regions: list[int], rows: DataFrame) -> None:
        """Write ``rows`` as the new contents of the regions; a region that has
        none left is emptied."""
        new = cut_lineage(rows)                              # before its source is overwritten
        self._write(new, dynamic=True)
        kept = set(self._regions(new))
        release(new)
        for region in set(regions) - kept:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/region={region}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def put(self, changes: DataFrame, version: str | None = None) -> list[int]:
        """``upsert`` in the regions of the changes, which are returned."""
        changes = cut_lineage(changes)                       # may be derived from this table
        regions = self._regions(changes)
        if regions:
            old = self.read().where(F.col("region").isin(regions)).drop("region")
            self._replace(regions, upsert(old, changes, self.key, version))
        release(changes)
        return sorted(regions)

    def delete(self, keys: DataFrame) -> list[int]:
        """``delete_keys`` in the regions of the keys, which are returned."""
        keys = cut_lineage(keys.select(self.key).distinct())
        regions = self._regions(keys)
        if regions:
            old = self.read().where(F.col("region").isin(regions)).drop("region")
            self._replace(regions, delete_keys(old, keys, self.key))
        release(keys)
        return sorted(regions)

    def get(self, value: str) -> DataFrame:
        """One row; the key's region prunes the files, the key the row groups."""
        region = self.spark.range(1).select(key_region(F.lit(value), self.splits)).first()[0]
        return get(self.read().where(F.col("region") == region).drop("region"), value, self.key)

    def files(self) -> DataFrame:
        """The table's files by region: ``region, file, modified``."""
        rows = self.read().select("region", F.col("_metadata.file_path").alias("file"),
                                  F.col("_metadata.file_modification_time").alias("modified"))
        return rows.distinct()
