"""Approximate nearest neighbours: NN-descent in Spark joins, greedy graph search.

``build`` makes an index of all vectors:

1. Equal vectors are one node, which keeps its ``copies`` smallest ids (more can
   never be among the nearest), so thousands of copies cost no more than one.
   Nodes have dense numbers in the order of a hash.  For the search of neighbours
   a node is known by a code: its direction in bytes and their scale.
2. First lists: nodes meet in cells of about ``CELL``, given by the signs of
   random projections, ``PASSES`` times; each keeps the ``NEAR`` best.
3. Rounds of descent: a node brings its neighbours and those that have it as a
   neighbour together, and pairs of them of which one is new are compared.  Each
   side gets what beats its list's last entry.  A node that many have as a
   neighbour is dealt into parts, its own neighbours being in each, so no reverse
   neighbour is left out and no group grows.  Rounds end when less than ``SETTLED``
   of all entries are new.

``search`` keeps a beam of ``BEAM`` nodes per query.  In each hop the nodes of the
beam that were not used yet bring their neighbours in both directions; candidates
meet the codes in blocks of nodes, and what beats the beam's last entry comes in.
A query begins at its own node, if the index has it, and at ``ENTRIES`` random
nodes, and ends when all of its beam was used.  Scores are cosines of the original
vectors in double precision, of the ``RESCORED`` first of the beam.

State is cut after each round and hop; a lost executor costs one of them.  Codes
of ``BLOCK`` nodes are the most that a group of a search holds besides its queries.

Defined cases: vectors that are null, zero or hold a null or non-finite component
take no part; a shorter vector counts as filled up with zeros; a query row is no
candidate of its own, but rows that repeat it (also with its id) are; ties go to
the smaller id, null ids last; fewer candidates than asked for are all returned;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rill.operators.sorting import add_row_index
from rill.session import cut_lineage, release, store_bucketed

NEAR, PASSES, CELL, SETTLED = 12, 10, 1024, 0.05
BEAM, ENTRIES, BLOCK, RESCORED = 320, 2, 1024, 32
#: Reverse neighbours of a node in one group.
PART = 4 * NEAR
LISTS = "node long, near array<long>, sim array<float>, fresh array<boolean>"


@dataclass
class Index:
    nodes: DataFrame        # node, v (as given), ids
    codes: DataFrame        # block, node, code, scale; in buckets by block
    edges: DataFrame        # src, dst, in both directions; in buckets by src
    count: int
    width: int
    block: int              # nodes of a block


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and v (array of double) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    x = F.col("v")
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return rows.filter(x.isNotNull() & fine & F.exists(x, lambda c: c != 0))


def numbered(rows: DataFrame, copies: int) -> DataFrame:
    """node, v and ids (the ``copies`` smallest, nulls last) of different vectors."""
    order = Window.partitionBy("v", "salt").orderBy(F.asc_nulls_last("id"))
    few = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(32))).withColumn("n", F.row_number().over(order))
    few = few.filter(F.col("n") <= copies).groupBy("v").agg(
        F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id")).alias("ids"))
    few = few.select("v", F.slice(F.sort_array("ids"), 1, copies)["id"].alias("ids"))
    return add_row_index(cut_lineage(few), [F.xxhash64("v"), F.col("v")], name="node")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, short ones filled up with zeros."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width))
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def coded(rows: DataFrame, key: str, width: int) -> DataFrame:
    """key, code (bytes) and scale: code * scale is the vector at length 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), width)
            x /= np.abs(x).max(1, keepdims=True)
            code = np.rint(x * 127).astype(np.int8)
            scale = 1 / (127 * np.sqrt((x * x).sum(1)))
            data = pa.Array.from_buffers(pa.binary(width), len(b), [None, pa.py_buffer(code)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(key), data, pa.array(scale.astype("f4"))], [key, "code", "scale"])

    return rows.select(key, "v").mapInArrow(run, f"{key} long, code binary, scale float")


def directions(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    code = rows.column("code")
    code = np.frombuffer(b"".join(code.to_pylist()), np.int8).reshape(len(code), -1).astype("f4")
    return code * rows.column("scale").to_numpy()[:, None]


def list_rows(owner: np.ndarray, near: np.ndarray, sim: np.ndarray, fresh: np.ndarray, width: int) -> pa.RecordBatch:
    """One row per owner: its ``width`` best, each once (as used, if it was)."""
    order = np.lexsort((fresh, near, owner))
    owner, near, sim, fresh = owner[order], near[order], sim[order], fresh[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (near[1:] != near[:-1])
    owner, near, sim, fresh = owner[first], near[first], sim[first], fresh[first]
    order = np.lexsort((near, -sim, owner))
    owner, near, sim, fresh = owner[order], near[order], sim[order], fresh[order]
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    begin = np.flatnonzero(new)
    use = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner)))) < width
    offsets = pa.array(np.append(0, np.cumsum(use))[np.append(begin, len(owner))].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[begin]), *(pa.ListArray.from_arrays(offsets, pa.array(a[use])) for a in (near, sim.astype("f4"), fresh))],
        ["node", "near", "sim", "fresh"])


def flat(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    owner = np.repeat(rows.column("node").to_numpy(), rows.column("near").value_lengths().to_numpy())
    return owner, *(rows.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("near", "sim", "fresh"))


def runs_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key`` in pieces that never part equal keys."""
    kept = None
    for b in batches:
        if not len(b):
            continue
        b = b if kept is None else pa.concat_batches([kept, b])
        last = np.zeros(len(b), bool)
        for c in key:
            last |= pc.not_equal(b.column(c), b.column(c)[len(b) - 1]).to_numpy(zero_copy_only=False)
        there = np.flatnonzero(last)
        cut = there[-1] + 1 if len(there) else 0
        if cut:
            yield b[:cut]
        kept = b[cut:]
    if kept is not None:
        yield kept


def best_lists(rows: DataFrame, width: int) -> DataFrame:
    """The rows of each node put together, the ``width`` best of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs_of(batches, ["node"]):
            yield list_rows(*flat(b), width)

    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, LISTS)


def cell_lists(codes: DataFrame, count: int, width: int, near: int, passes: int, cell: int) -> DataFrame:
    """First lists, from cells of nodes on the same sides of random planes."""
    bits = max(0, int(np.ceil(np.log2(max(count, 1) / cell))))
    passes = passes if bits else 1

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(11).normal(size=(width, passes * bits)).astype("f4")
        for b in batches:
            side = (directions(b) @ planes > 0).reshape(len(b), passes, bits)
            value = (side << np.arange(bits)).sum(2) if bits else np.zeros((len(b), passes), np.int64)
            for p in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), p, np.int32)), pa.array(value[:, p].astype(np.int64)), *b.columns],
                    ["pass", "cell", *b.schema.names])

    kind = "pass int, cell long, node long, code binary, scale float"
    rows = cut_lineage(codes.mapInArrow(sides, kind))
    parts = rows.groupBy("pass", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * cell)).alias("parts"))
    rows = rows.join(parts, ["pass", "cell"]).withColumn("part", F.pmod(F.xxhash64("node", "pass"), "parts"))

    def meet(group: pa.Table) -> pa.Table:
        x, node = directions(group.combine_chunks()), group["node"].to_numpy()
        sim = x @ x.T
        np.fill_diagonal(sim, -9)
        k = min(near, len(node) - 1)
        if not k:
            return pa.table({"node": node[:0], "near": pa.array([], pa.list_(pa.int64())),
                             "sim": pa.array([], pa.list_(pa.float32())), "fresh": pa.array([], pa.list_(pa.bool_()))})
        there = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        found = np.take_along_axis(sim, there, 1).ravel()
        return pa.Table.from_batches([list_rows(np.repeat(node, k), node[there.ravel()], found, np.ones(len(found), bool), near)])

    lists = rows.select("pass", "cell", "part", "node", "code", "scale").groupBy("pass", "cell", "part").applyInArrow(meet, LISTS)
    return best_lists(lists, near)


def descend(lists: DataFrame, codes: DataFrame, near: int, part: int) -> DataFrame:
    """One round: the lists with what neighbours of neighbours add."""
    each = lists.select("node", F.explode(F.arrays_zip("near", "fresh")).alias("e")).select(
        "node", F.col("e.near").alias("other"), F.col("e.fresh").alias("fresh"))
    back = each.select(F.col("other").alias("center"), F.col("node").alias("member"), "fresh")
    ahead = each.select(F.col("node").alias("center"), F.col("other").alias("member"), "fresh")
    centers = ahead.withColumn("back", F.lit(0)).unionByName(back.withColumn("back", F.lit(1))).groupBy("center").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("back") / part)).cast("int").alias("parts"), F.bool_or("fresh").alias("any")).filter("any")
    centers = cut_lineage(centers.drop("any"))
    back = back.join(centers, "center").withColumn("part", F.pmod(F.xxhash64("member"), "parts").cast("int"))
    ahead = ahead.join(centers, "center").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = ahead.unionByName(back).groupBy("center", "part", "member").agg(F.bool_or("fresh").alias("fresh"))
    least = F.when(F.size("near") < near, F.lit(-9.0)).otherwise(F.element_at("sim", -1)).cast("float")
    known = codes.join(lists.select("node", least.alias("least")), "node", "left").withColumnRenamed("node", "member")
    rows = members.join(known.fillna(-9.0, ["least"]), "member").repartition("center").sortWithinPartitions("center", "part")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs_of(batches, ["center", "part"]):
            x, node = directions(b), b.column("member").to_numpy()
            least, fresh = b.column("least").to_numpy(), b.column("fresh").to_numpy(zero_copy_only=False)
            group = np.stack([b.column("center").to_numpy(), b.column("part").to_numpy()])
            at = np.append(np.flatnonzero(np.append(True, (group[:, 1:] != group[:, :-1]).any(0))), len(b))
            found = []
            for s, e in zip(at[:-1], at[1:], strict=True):
                sim = x[s:e] @ x[s:e].T
                good = (sim > least[s:e, None]) & (fresh[s:e, None] | fresh[None, s:e])
                np.fill_diagonal(good, False)
                i, j = np.nonzero(good)
                if len(i):
                    found.append((node[s + i], node[s + j], sim[i, j]))
            if found:
                i, j, sim = (np.concatenate(a) for a in zip(*found, strict=True))
                yield list_rows(i, j, sim, np.ones(len(i), bool), near)

    rows = rows.select("center", "part", "member", "fresh", "code", "scale", "least")
    used = lists.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False)))
    return best_lists(used.unionByName(rows.mapInArrow(meet, LISTS)), near)


def share_fresh(lists: DataFrame) -> float:
    row = lists.agg(F.sum(F.size(F.filter("fresh", lambda f: f))), F.sum(F.size("fresh"))).first()
    return (row[0] or 0) / (row[1] or 1)


def build(vectors: DataFrame, copies: int, id_col: str = "vec_id", vector_col: str = "embedding", near: int = NEAR,
          passes: int = PASSES, cell: int = CELL, part: int = PART, settled: float = SETTLED, block: int = BLOCK,
          told: Callable[[int, float], None] = lambda *_: None) -> Index:
    """Index of all valid vectors; ``told`` hears each round's share of new entries."""
    nodes = cut_lineage(numbered(valid(vectors, id_col, vector_col), copies))
    count, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    codes = cut_lineage(coded(nodes, "node", width or 1))
    lists = cut_lineage(cell_lists(codes, count, width or 1, near, passes, cell))
    turn = 0
    while (share := share_fresh(lists)) > settled:
        told(turn, share)
        before, lists = lists, cut_lineage(descend(lists, codes, near, part))
        release(before)
        turn += 1
    told(turn, share)
    ahead = lists.select(F.col("node").alias("src"), F.explode("near").alias("dst"))
    # what every hop of a search reads lies as its joins want it
    edges = store_bucketed(ahead.union(ahead.select("dst", "src")).distinct(), "src")
    held = store_bucketed(codes.withColumn("block", (F.col("node") / block).cast("long")), "block")
    for used in (lists, codes):
        release(used)
    return Index(nodes, held, edges, count, width or 1, block)


def hop(beam: DataFrame, asked: DataFrame, index: Index, width: int) -> DataFrame:
    """The beams with the neighbours of all their nodes that were not used yet."""
    least = F.when(F.size("near") < width, F.lit(-9.0)).otherwise(F.element_at("sim", -1)).cast("float")
    front = beam.select(F.col("node").alias("q"), least.alias("least"), F.explode(F.arrays_zip("near", "fresh")).alias("e"))
    front = front.filter("e.fresh").select("q", "least", F.col("e.near").alias("src"))
    return admitted(front.join(index.edges, "src").select("q", F.col("dst").alias("node"), "least"), beam, asked, index, width)


def admitted(candidates: DataFrame, beam: DataFrame | None, asked: DataFrame, index: Index, width: int) -> DataFrame:
    """The beams with those candidates (q, node, least) that are nearer than ``least``."""
    wanted = candidates.groupBy((F.col("node") / index.block).cast("long").alias("block"), "q").agg(
        F.collect_set("node").alias("wanted"), F.max("least").alias("least")).join(asked, "q")
    wanted = wanted.select("block", "q", "wanted", "code", "scale", "least")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = directions(left.combine_chunks()), directions(right.combine_chunks())
        node = right["node"].to_numpy()
        by = np.argsort(node)
        lists = left["wanted"].combine_chunks()
        owner = np.repeat(np.arange(len(left)), lists.value_lengths().to_numpy())
        near = lists.flatten().to_numpy()
        there = by[np.searchsorted(node, near, sorter=by)]
        sim = np.empty(len(near), "f4")
        for a in range(0, len(near), 1 << 16):
            s = slice(a, a + (1 << 16))
            sim[s] = (q[owner[s]] * x[there[s]]).sum(1)
        good = sim > left["least"].to_numpy()[owner]
        rows = list_rows(left["q"].to_numpy()[owner[good]], near[good], sim[good], np.ones(int(good.sum()), bool), width)
        return pa.Table.from_batches([rows])

    found = wanted.groupBy("block").cogroup(index.codes.groupBy("block")).applyInArrow(
        lambda left, right: meet(left, right) if len(left) else empty_lists(), LISTS)
    if beam is not None:
        found = found.unionByName(beam.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False))))
    return best_lists(found, width)


def empty_lists() -> pa.Table:
    none = np.zeros(0)
    return pa.Table.from_batches([list_rows(none.astype(np.int64), none.astype(np.int64), none, none.astype(bool), 1)])


def search(index: Index, queries: DataFrame, k: int, id_col: str = "vec_id", beam: int = BEAM, entries: int = ENTRIES,
           rescored: int = RESCORED, spent: bool = False, told: Callable[[int], None] = lambda *_: None) -> DataFrame:
    """query_id, rank, ``id_col`` and score of the ``k`` nearest found of every row
    (id, v) of ``queries``; the row itself, if indexed, is left out.  The index
    must hold k + 1 copies; its graph is deleted after this search if ``spent``."""
    rows = cut_lineage(queries)
    asked = rows.select("v").distinct()
    asked = cut_lineage(add_row_index(cut_lineage(asked), [F.xxhash64("v"), F.col("v")], name="q"))
    codes = cut_lineage(coded(asked, "q", index.width))
    own = asked.join(index.nodes.select("v", "node"), "v").select("q", "node")
    any_ = asked.select("q", F.explode(F.sequence(F.lit(1), F.lit(entries))).alias("i")).select(
        "q", F.pmod(F.xxhash64("q", "i"), F.lit(max(index.count, 1))).alias("node"))
    begin = own.union(any_).withColumn("least", F.lit(-9.0).cast("float"))
    state = cut_lineage(admitted(begin, None, codes, index, beam))
    turn = 0
    while not state.filter(F.exists("fresh", lambda f: f)).isEmpty():
        before, state = state, cut_lineage(hop(state, codes, index, beam))
        release(before)
        turn += 1
    told(turn)
    for used in (index.edges, index.codes, codes) if spent else (codes,):
        release(used)
    near = state.select(F.col("node").alias("q"), F.explode(F.slice("near", 1, rescored)).alias("node"))
    pairs = near.join(index.nodes, "node").join(asked.withColumnRenamed("v", "u"), "q")
    scored = pairs.select("q", F.explode("ids").alias("id"), cosine(F.col("u"), F.col("v")).alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    first = scored.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    first = first.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("first"))
    first = first.join(asked, "q").drop("q")
    named = rows.join(first, "v")
    mine = F.coalesce(F.array_position(F.transform("first", lambda c: c["id"]), F.col("id")), F.lit(0))
    named = named.withColumn("mine", mine).select("id", F.posexplode(F.slice(F.filter(
        "first", lambda c: c["n"] != F.col("mine")), 1, k)).alias("pos", "f"))
    return named.select(F.col("id").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"),
                        F.col("f.id").alias(id_col), F.col("f.score").alias("score"))


def cosine(a: Column, b: Column) -> Column:
    """In double precision; vectors of extreme size are brought to size 1 first."""
    def plain(x: Column, y: Column) -> Column:
        dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda s, t: F.coalesce(s, F.lit(0.0)) * F.coalesce(t, F.lit(0.0))),
                                       F.lit(0.0), lambda s, t: s + t)
        return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))

    most = lambda x: F.array_max(F.transform(x, lambda c: F.abs(c)))
    fine = (F.greatest(most(a), most(b)) < 1e150) & (F.least(most(a), most(b)) > 1e-150)
    unit = lambda x: F.transform(x, lambda c: c / most(x))
    return F.when(fine, plain(a, b)).otherwise(plain(unit(a), unit(b)))
