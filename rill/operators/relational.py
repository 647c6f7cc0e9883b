"""Relational building blocks: aggregates, shares, per-group top-k, pivots.

All of them are compositions of DataFrame operators; Catalyst plans the
partial/final aggregation (map-side combine), the window sorts and the
top-k (``TakeOrderedAndProject``) itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def count_by(df: DataFrame, keys, name: str = "cnt") -> DataFrame:
    """Rows per key (partial + final hash aggregate)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def average_per_distinct(df: DataFrame, key: str, per: str, value: str,
                         name: str = "avg_value") -> DataFrame:
    """``sum(value) / count(distinct per)`` for each key.

    This is deliberately not ``avg``: a key seen three times in one year and
    once in another has two distinct years, so the sum is divided by two.

    Values of ``per`` that are whole numbers in a range of at most ``MASK_RANGE``
    (years, months) are counted as the bits of masks, 63 to a mask: a mask is a
    state of eight bytes that merges by "or" before the shuffle, so one exchange
    on the key is all.  A distinct count shuffles every (key, value) pair first.
    The range is read from the data; other values take the distinct count.
    """
    seen = _whole_range(df, per)
    if seen is None:
        return (df.groupBy(key)
                .agg((F.sum(value).cast("double") / F.count_distinct(per)).alias(name)))
    low, high = seen
    at = F.col(per).cast("long") - F.lit(low)
    masks = [F.bit_or(F.when(F.floor(at / 63) == m, F.call_function(
        "shiftleft", F.lit(1).cast("long"), (at % 63).cast("int")))) for m in range((high - low) // 63 + 1)]
    distinct = sum((F.coalesce(F.bit_count(m), F.lit(0)) for m in masks), F.lit(0))
    return df.groupBy(key).agg((F.sum(value).cast("double") / F.nullif(distinct, F.lit(0))).alias(name))


#: Width of the range of values that ``average_per_distinct`` keeps as bits.
MASK_RANGE = 63 * 16


def _whole_range(df: DataFrame, col: str) -> tuple[int, int] | None:
    """Least and largest value of an integer column, if they are near enough."""
    if df.schema[col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return None
    low, high = df.agg(F.min(col), F.max(col)).first()
    return (low, high) if low is not None and high - low < MASK_RANGE else None


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Global ORDER BY + LIMIT, planned as a top-k."""
    return df.orderBy(*order).limit(n)


def share_of_total(df: DataFrame, partition: Sequence[str] | str, value: str,
                   name: str = "share") -> DataFrame:
    """``value / sum(value) over (partition by ...)``.

    The frame is the whole partition.  Partitions are groups of an already
    aggregated table, so each holds only the distinct keys of that group.
    """
    w = Window.partitionBy(*_cols(partition))
    return df.withColumn(name, F.col(value) / F.sum(value).over(w))


def top_k_per_group(df: DataFrame, group, order: Sequence[Column], k: int,
                    rank_fn: str = "row_number", rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of every group.

    ``row_number`` gives exactly k rows per group (the order must be total
    for a deterministic answer); ``rank`` keeps ties and may return more.
    Spark plans the filter on a ranking window as a per-partition
    group-limit before the shuffle when it can.
    """
    fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[rank_fn]
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    return df.withColumn(rank_col, fn().over(w)).where(F.col(rank_col) <= k)


def argmax(df: DataFrame, value: str, *tie_break: Column) -> DataFrame:
    """The row with the largest ``value`` (ties by ``tie_break``)."""
    return df.orderBy(F.col(value).desc(), *tie_break).limit(1)


def complete_row_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Total rows and rows with no null in ``cols`` in one pass
    (the same as ``count()`` and ``na.drop("any").count()``)."""
    cols = list(cols or df.columns)
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(complete).alias("complete_rows"))


def pivot_ranks(df: DataFrame, key: str, rank: str, value: str, ranks: Sequence[int],
                prefix: str = "v") -> DataFrame:
    """One wide row per key from rank-numbered rows; a key missing any
    of ``ranks`` is dropped (the inner-join semantics of the three-way join)."""
    wide = (df.groupBy(key).pivot(rank, list(ranks)).agg(F.first(value)))
    out = wide.select(key, *[F.col(str(r)).alias(f"{prefix}{r}") for r in ranks])
    return out.na.drop("any", subset=[f"{prefix}{r}" for r in ranks])


def union_counts(parts: dict[str, DataFrame], whole: DataFrame) -> DataFrame:
    """Row count of every part, of their union-all (by one rollup over
    the tagged union) and, counted on its own, of the table they came from, so
    that rows that no part took are seen."""
    tagged = None
    for name, part in parts.items():
        t = part.select(F.lit(name).alias("part"))
        tagged = t if tagged is None else tagged.unionByName(t)
    counted = tagged.rollup("part").agg(F.count(F.lit(1)).alias("rows"), F.grouping("part").alias("all"))
    counted = counted.select(F.when(F.col("all") == 1, "all").otherwise(F.col("part")).alias("part"), "rows")
    return counted.unionByName(whole.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("table").alias("part"), "rows"))


def merge_single_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Put several one-row results (with distinct columns) side by side.

    The rows are stacked with null padding and folded by one aggregate, so
    no join between the single-row plans is needed.
    """
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols.extend(f.columns)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def next_in_group(df: DataFrame, group: str, order: Sequence[str], value: str,
                  out: str = "nxt") -> DataFrame:
    """``lead(value) over (partition by group order by order)`` without putting
    a group into one task: rows get dense numbers along ``(group, *order)``
    (range partitioned, so a large group is spread), and a row's successor is
    the row with the next number, if it is of the same group.  Null groups are
    one group; ``(group, *order)`` should be unique for a reproducible answer.
    Returns ``group, value, out``.
    """
    from rill.operators.sorting import add_row_index
    from rill.session import cut_lineage

    rows = add_row_index(df.select(*dict.fromkeys([group, *order, value])), [group, *order], "__ix")
    rows = cut_lineage(rows.select(group, value, "__ix"))
    after = rows.select(F.col(group).alias("__g"), F.col(value).alias("__v"), (F.col("__ix") - 1).alias("__ix"))
    same = F.col(group).eqNullSafe(F.col("__g"))
    return rows.join(after, "__ix", "left").select(group, value, F.when(same, F.col("__v")).alias(out))


def id_ends_with(col: str | Column, suffix: str) -> Column:
    """The report filter ``ENDSWITH(CAST(id AS STRING), suffix)``
    (same rows as ``CAST(id AS STRING) LIKE CONCAT('%', suffix)``)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string").endswith(suffix)
