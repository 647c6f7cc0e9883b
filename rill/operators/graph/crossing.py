"""Four-edge temporal motifs counted without binding four edges.

In both motifs two vertices a and b act by turns, e1 and e3 by a, e2 and e4 by b,
in strict time order e1 < e2 < e3 < e4.  So a's two edges are an interval (e1, e3),
b's are (e2, e4), and the motif says that b's interval begins inside a's and ends
after it: the intervals cross.

* ``intervals``: per vertex, two of its out-edges to different targets in time
  order: ``id, s, y, begin, end`` (s and y are their targets).  Out-edges of a
  vertex are dealt into parts beyond ``SPLIT``, the earlier edge to one part, the
  later one to all, so a busy vertex is spread over tasks.
* ``crossings``: pairs of intervals of one group that cross, for several groupings
  at once.  Conditions such as "a is not b" are differences of such counts.
  The pairs are counted, not made: of intervals i and j in order of begin, those
  with ``end i < end j`` are the ascending pairs of a permutation
  (``count_ascents``); those with ``end i <= begin j`` are taken off.
* Intervals travel packed: a task sends a cell one row with a column's numbers as
  bytes.  A cell holds many small groups, or one slab of time of a group of more
  than ``PART`` intervals.  Such an interval is sent to the slab it begins in and
  to the one it ends in: pairs that share either are counted there, the others
  follow from the numbers of intervals per pair of slabs.  Intervals that begin
  or end at one time lie in one slab, however many they are.

Rows in proportion to the intervals, that is to the squares of the out-degrees;
bindings of four edges, their squares once more, are never made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rill.operators.sorting import add_row_index
from rill.session import cut_lineage

SPLIT, PART = 4000, 1 << 20
#: Intervals that a task packs at once, and those of small groups in a cell.
CHUNK, CELL = 1 << 20, 1 << 19


def _numbered(edges: DataFrame, time_col: str) -> DataFrame:
    """Edges with their time's place among all times (``t``): whole numbers, which pack well."""
    e = edges.select("src", "dst", F.col(time_col).alias("time")).where("time is not null")
    places = add_row_index(e.select("time").distinct(), "time", "t")
    return e.join(places, "time").select("src", "dst", "t")


def intervals(edges: DataFrame, time_col: str = "timestamp", split: int = SPLIT) -> DataFrame:
    """Two out-edges of a vertex to different targets, one strictly later."""
    e = edges.select("src", "dst", F.col(time_col).alias("t"))
    degree = e.groupBy("src").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > split)
    parts = degree.select("src", F.ceil(F.col("d") / F.lit(split)).cast("int").alias("parts"))
    e = e.join(parts, "src", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    first = e.select("src", F.pmod(F.xxhash64("dst", "t"), "parts").cast("int").alias("part"),
                     F.col("dst").alias("s"), F.col("t").alias("begin"))
    later = e.select("src", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                     F.col("dst").alias("y"), F.col("t").alias("end"))
    return (first.join(later, ["src", "part"]).where((F.col("begin") < F.col("end")) & (F.col("s") != F.col("y")))
            .select(F.col("src").alias("id"), "s", "y", "begin", "end"))


def count_ascents(x: np.ndarray) -> int:
    """Pairs (i, j) with i < j and x[i] < x[j] of a permutation of 0 .. n - 1.

    Sorted by one binary digit after the other, the highest first: a block holds
    the values of equal higher digits in their old order, and each value with digit
    one counts the values with digit zero before it in the block."""
    n = len(x)
    if n < 2:
        return 0
    size = block = 1 << (n - 1).bit_length()
    x = np.concatenate([x, np.arange(n, size)]).astype(np.int32 if size <= 1 << 30 else np.int64)
    total = -(n * (size - n) + (size - n) * (size - n - 1) // 2)         # what the filling adds
    while block > 1:
        half = block >> 1
        one = (x & half) != 0
        at = np.flatnonzero(one)
        total += int((at & (block - 1)).sum()) - size // block * (half * (half - 1) // 2)
        new = np.empty((size // block, 2, half), x.dtype)
        new[:, 0] = x[~one].reshape(-1, half)
        new[:, 1] = x[at].reshape(-1, half)
        x, block = new.reshape(-1), half
    return total


def _codes(n: int, columns: Sequence[np.ndarray]) -> np.ndarray:
    """Numbers 0, 1, ... of the different rows of ``columns``, in the smallest type."""
    out = np.zeros(n, np.int64)
    for c in columns:
        k = pd.factorize(c)[0]
        out = pd.factorize(out * (int(k.max(initial=0)) + 1) + k)[0]
    return out.astype(np.min_scalar_type(int(out.max(initial=0))))


def _orders(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of begin (of equal ones the later end first), and its places in order of
    end (of equal ones the later place first): pairs of equal begin or end never ascend."""
    by_begin = np.lexsort((-end, begin))
    return by_begin, np.lexsort((-np.arange(len(end)), end[by_begin]))


def _ascending(group: np.ndarray, by_begin: np.ndarray, by_end: np.ndarray) -> int:
    """Pairs of one group that ascend in both begin and end."""
    n = len(group)
    g = group[by_begin]
    place, x = np.empty(n, np.int64), np.empty(n, np.int64)
    place[np.argsort(g, kind="stable")] = np.arange(n)                  # group, then begin
    x[place[by_end[np.argsort(g[by_end], kind="stable")]]] = np.arange(n)   # group, then end
    sizes = np.bincount(group)
    return count_ascents(x) - (n * n - int((sizes * sizes).sum())) // 2     # pairs of two groups all ascend


def _ended(g_end: np.ndarray, end: np.ndarray, g_begin: np.ndarray, begin: np.ndarray) -> int:
    """Pairs of one group with end i <= begin j."""
    if not len(end) or not len(begin):
        return 0
    m = len(end)
    g, t = np.concatenate([g_end, g_begin]), np.concatenate([end, begin])
    order = np.argsort(t, kind="stable")                                # of equal times the ends first
    order = order[np.argsort(g[order], kind="stable")]
    is_end = order < m
    sizes = np.bincount(g_end, minlength=int(g.max()) + 1)
    base = np.cumsum(sizes) - sizes
    return int((np.cumsum(is_end)[~is_end] - base[g[order[~is_end]]]).sum())


def count_crossings(group: np.ndarray, begin: np.ndarray, end: np.ndarray) -> int:
    """Pairs (i, j) of one group with begin i < begin j < end i < end j."""
    if not len(group):
        return 0
    group = _codes(len(group), [group])
    return _ascending(group, *_orders(begin, end)) - _ended(group, end, group, begin)


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers in the smallest signed type that has them all."""
    low, high = int(x.min()), int(x.max())
    kind = next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(kind).tobytes()


def _unpack(parts: list[tuple[int, list[bytes]]], width: int) -> list[np.ndarray]:
    """The columns of all packed rows of a cell."""
    columns = [[np.frombuffer(row[c], f"i{len(row[c]) // n}").astype(np.int64) for n, row in parts] for c in range(width)]
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]


def _large_groups(rows: DataFrame, group: list[str], part: int) -> tuple[int, pd.DataFrame, list[np.ndarray]]:
    """The number of intervals, the groups of more than ``part``, and the times that
    cut each of these into slabs: at most two numbers for each ``part`` intervals."""
    seen = Observation()
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).observe(seen, F.sum("n").alias("all"))
    large = sizes.where(F.col("n") > part).collect()
    total = seen.get["all"] or 0
    if not large:
        return total, pd.DataFrame(columns=group), []
    steps = min(10_000, 4 * -(-2 * max(r.n for r in large) // part))
    at = [i / steps for i in range(1, steps)]
    named = rows.sparkSession.createDataFrame(large, sizes.schema).select(*group, "n")
    spread = rows.join(F.broadcast(named), group).groupBy(*group, "n").agg(
        F.percentile_approx("begin", at).alias("b"), F.percentile_approx("end", at).alias("e")).collect()
    cuts = []
    for r in spread:
        both, slabs = np.sort(np.array(r.b + r.e)), -(-2 * r.n // part)
        cuts.append(np.unique(both[[len(both) * i // slabs for i in range(1, slabs)]]))
    return total, pd.DataFrame([r[:len(group)] for r in spread], columns=group), cuts


def crossings(rows: DataFrame, group: Sequence[str], finer: dict[str, Sequence[str]], part: int = PART) -> DataFrame:
    """One row: per name in ``finer`` the crossing pairs of intervals that agree in
    ``group`` and in the columns named there (decimals).  All columns are whole numbers."""
    group, names = list(group), list(finer)
    keys = list(dict.fromkeys([*group, *[c for cs in finer.values() for c in cs]]))
    rows = rows.select(*[F.col(c).cast("long").alias(c) for c in (*keys, "begin", "end")])
    total, large, cuts = _large_groups(rows, group, part)
    buckets = max(1, -(-total // min(CELL, part)))
    base = buckets + np.cumsum([0, *[len(c) + 1 for c in cuts]])         # first cell of each large group
    wide = len(keys) + 2

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= CHUNK:
                yield from packed(held)
                held, n = [], 0
        if n:
            yield from packed(held)

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        cols = [t.column(c).to_numpy() for c in (*keys, "begin", "end")]
        begin, end = cols[-2:]
        spread = np.zeros(len(begin), np.uint64)
        for c in cols[:len(group)]:
            spread = (spread ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            spread ^= spread >> np.uint64(29)
        cell = (spread % np.uint64(buckets)).astype(np.int64)
        late = np.zeros(len(begin), bool)
        last, started = cell.copy(), np.zeros(len(begin), np.int64)
        if cuts:
            known = large.assign(k=range(len(large)))
            which = pd.DataFrame(dict(zip(group, cols))).merge(known, "left", group)["k"].fillna(-1).to_numpy().astype(int)
            order = np.argsort(which, kind="stable")
            bounds = np.searchsorted(which[order], np.arange(len(large) + 1))
            for k, cut in enumerate(cuts):
                at = order[bounds[k]:bounds[k + 1]]
                started[at] = np.searchsorted(cut, begin[at], side="right")
                cell[at], last[at] = base[k] + started[at], base[k] + np.searchsorted(cut, end[at], side="right")
            late = last != cell
        yield from sent(cell, cols, 0)
        if late.any():                     # where they end, with the slab they began in
            yield from sent(last[late], [c[late] for c in (*cols[:-2], started, end)], 1)

    def sent(cell: np.ndarray, cols: list[np.ndarray], kind: int) -> Iterator[pa.RecordBatch]:
        order = np.argsort(cell, kind="stable")
        cell, cols = cell[order], [c[order] for c in cols]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        ends = np.r_[starts[1:], len(cell)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell[starts]), pa.array(np.full(len(starts), kind, np.int32)), pa.array(ends - starts),
             *[pa.array([_pack(c[i:j]) for i, j in zip(starts, ends)], pa.binary()) for c in cols]],
            ["cell", "kind", "n", *[f"c{i}" for i in range(wide)]])

    # numbers of a cell, and how many intervals of a slab end in which
    result = ", ".join(["name int", *[f"k{i} long" for i in range(len(keys))], "began int", "ended int", "n long", "found long"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        cell, held = None, ([], [])
        for batch in batches:
            blobs = [batch.column(f"c{i}") for i in range(wide)]
            for i, (c, kind, n) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("cell", "kind", "n")))):
                if c != cell and cell is not None:
                    yield from counted(cell, *held)
                    held = ([], [])
                cell = c
                held[kind].append((n, [b[i].as_py() for b in blobs]))
        if cell is not None:
            yield from counted(cell, *held)

    def counted(cell: int, here: list, late: list) -> Iterator[pa.RecordBatch]:
        cols, more = _unpack(here, wide), _unpack(late, wide)
        begin, end = cols[-2:]
        m, orders = len(begin), _orders(begin, end)
        k = int(np.searchsorted(base, cell, side="right")) - 1
        slab = cell - int(base[k]) if k >= 0 else 0
        ended = np.searchsorted(cuts[k], end, side="right") if k >= 0 else np.zeros(m, np.int64)
        both = [np.concatenate(x) for x in zip(cols, more)]
        if k >= 0:                         # those that end in this slab, by the slab they began in
            on = np.concatenate([ended == slab, np.ones(len(more[0]), bool)])
            since = np.concatenate([np.full(m, slab), more[-2]])[on]
            slabs_orders = _orders(since, both[-1][on])
        out = []
        for name, finest in enumerate(finer.values()):
            own = [*group, *[c for c in finest if c not in group]]
            g = _codes(len(both[0]), [both[keys.index(c)] for c in own])
            found = _ascending(g[:m], *orders) if m else 0
            if k < 0:
                found -= _ended(g, end, g, begin)
            else:
                found += _ascending(g[on], *slabs_orders) if on.any() else 0
                found -= _ended(g[on], both[-1][on], g[:m], begin)
                tab = pd.DataFrame({f"k{i}": cols[i] if c in own else 0 for i, c in enumerate(keys)} | {"ended": ended})
                tab = tab.groupby(list(tab.columns), sort=False).size().rename("n").reset_index()
                out.append(tab.assign(name=name, began=slab, found=0))
            out.append(pd.DataFrame({"name": [name], "began": 0, "ended": 0, "n": 0, "found": found} | {f"k{i}": 0 for i in range(len(keys))}))
        t = pa.Table.from_pandas(pd.concat(out)[[x.split()[0] for x in result.split(", ")]], preserve_index=False)
        kinds = pa.schema([(f, pa.int32() if kind == "int" else pa.int64()) for f, kind in (x.split() for x in result.split(", "))])
        yield from t.cast(kinds).to_batches(max_chunksize=10_000)

    blobs = ", ".join(f"c{i} binary" for i in range(wide))
    cells = rows.mapInArrow(pack, f"cell long, kind int, n long, {blobs}").repartition("cell").sortWithinPartitions("cell")
    counts = cells.mapInArrow(count, result)
    if cuts:
        counts = cut_lineage(counts)
        per = ["name", *[f"k{i}" for i in range(len(keys))]]
        table = counts.where("n > 0").groupBy(*per, "began", "ended").agg(F.sum("n").alias("n"))
        apart = table.repartition(*per).sortWithinPartitions(*per).mapInPandas(_apart(per), "name int, found long")
        counts = counts.select("name", "found").unionByName(apart)
    return counts.agg(*[F.coalesce(F.sum(F.when(F.col("name") == i, F.col("found").cast("decimal(38,0)"))), F.lit(0))
                        .cast("decimal(38,0)").alias(n) for i, n in enumerate(names)])


def _apart(per: list[str]):
    """Crossing pairs of intervals that share no slab, from rows ``per, began, ended, n``
    in order of ``per``."""
    def pairs(b: pd.DataFrame) -> pd.DataFrame:
        g = b.groupby(per, sort=False).ngroup().to_numpy()
        began, ended, n = (b[c].to_numpy() for c in ("began", "ended", "n"))
        shape = int(g.max()) + 1, int(max(began.max(), ended.max())) + 1
        found = np.zeros(shape[0], np.int64)
        before, begins, ends = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for s in range(shape[1]):
            on = began == s
            np.add.at(found, g[on], n[on] * (before.cumsum(1) - before)[g[on], ended[on]])
            np.add.at(before, (g[on], ended[on]), n[on])
        np.add.at(begins, (g, began), n)
        np.add.at(ends, (g, ended), n)
        found -= (begins * (ends.cumsum(1) - ends)).sum(1)
        name = b["name"].to_numpy()[np.unique(g, return_index=True)[1]]
        return pd.DataFrame({"name": name, "found": found})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for b in batches:
            b = b if kept is None else pd.concat([kept, b], ignore_index=True)
            if not len(b):
                continue
            key = b[per].to_numpy()
            other = np.flatnonzero((key != key[-1]).any(1))
            cut = other[-1] + 1 if len(other) else 0
            if cut:
                yield pairs(b.iloc[:cut])
            kept = b.iloc[cut:].reset_index(drop=True)
        if kept is not None and len(kept):
            yield pairs(kept)
    return run


def count_square_motif(edges: DataFrame, time_col: str = "timestamp", part: int = PART, split: int = SPLIT) -> DataFrame:
    """(v1)-[e1]->(v2); (v4)-[e2]->(v3); (v1)-[e3]->(v3); (v4)-[e4]->(v2) with
    v1 != v4, v2 != v3 and e1 < e2 < e3 < e4, as one row ``cnt``.

    v1's interval goes from v2 to v3, v4's from v3 to v2: crossing pairs over the
    same two targets, less those in the same direction, each less those of one
    vertex with itself."""
    rows = intervals(_numbered(edges, time_col), "t", split).withColumns({"low": F.least("s", "y"), "high": F.greatest("s", "y")})
    c = crossings(rows, ["low", "high"], {"all": [], "same_way": ["s"], "same_id": ["id"], "same_both": ["s", "id"]}, part)
    return c.select((F.col("all") - F.col("same_way") - F.col("same_id") + F.col("same_both")).cast("decimal(38,0)").alias("cnt"))


def count_fork_motif(edges: DataFrame, time_col: str = "timestamp", part: int = PART, split: int = SPLIT) -> DataFrame:
    """(v2)-[e1]->(v1); (v2)-[e3]->(v3); (v4)-[e4]->(v3); (v4)-[e2]->(v5) with
    v2 != v4, v1, v3, v5 different and e1 < e2 < e3 < e4, as one row ``cnt``.

    Both intervals end at v3: crossing pairs with the same end, less those of one
    vertex with itself, less those with the same beginning, plus those with both."""
    rows = intervals(_numbered(edges, time_col), "t", split)
    c = crossings(rows, ["y"], {"all": [], "same_start": ["s"]}, part)
    own = crossings(rows, ["id"], {"same_id": ["y"], "same_both": ["y", "s"]}, part)      # small groups
    return c.crossJoin(own).select(
        (F.col("all") - F.col("same_id") - F.col("same_start") + F.col("same_both")).cast("decimal(38,0)").alias("cnt"))
