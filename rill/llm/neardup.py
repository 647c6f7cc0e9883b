"""Near duplicates: BagMinHash signatures, banding, exact check of the multisets.

1. Each text gets a signature (``bagminhash``).  Equal texts share a key (MD5)
   and are represented by one row from then on, with partial aggregation, so
   thousands of copies cost no more than one.
2. The signature is cut into ``BANDS`` bands; texts that agree in a band share
   a bucket.  Two texts of similarity 0.8 share none with probability
   (1 - 0.8^4)^24 < 4e-6.
3. In each bucket the text with the least id is the hub, and the bucket's members
   are candidates with it: rows in proportion to the members, by joins whose
   large partitions Spark can split.
4. A candidate pair whose registers agree too seldom for 0.8 is dropped (loss
   below 1e-5 per pair); the others are checked by the exact weighted Jaccard
   similarity of their shingle multisets.
5. Links give classes (connected components).  Where the members besides the hub
   are still of several classes, all their pairs of different classes are
   compared (``rest``).  A bucket is dealt into parts of about ``PART`` texts and
   every two parts meet in one group, so no task holds a large bucket; pairs are
   made inside a group only, each in the first band that both texts share.

So every pair that shares a bucket is compared or already in one class, and the
classes are those of all such pairs.  The work of step 5 grows with the square of
what a bucket still holds, its rows with that square over ``PART``.

Defined cases: a text without words (null, empty) is alone in its class, one of
fewer than five words is one shingle; null ids are no class ids unless a class
has no other; rows that repeat are copies; an empty table gives no rows; the
input's columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rill.llm import bagminhash
from rill.llm.common import text_steps
from rill.operators.graph.components import connected_components
from rill.session import cut_lineage

ROWS, BANDS = 4, 24
LEAST, AGREE = 0.8, 58                # similarity; registers of 96 for a check
#: Bytes of text signed or checked at once; texts and bytes of a part of a bucket.
STEP_BYTES, PART, PART_BYTES = 2 << 20, 1024, 2 << 20


def signed(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """doc (struct), key, sig (null without words) and size (bytes of the text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*carry).alias("doc"),
                       F.unhex(F.md5(text)).alias("key"), F.octet_length(text).alias("size"), text.alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch, limit=STEP_BYTES):
                owner, code, weight = bagminhash.shingles(step.column("text"))
                sig = bagminhash.signatures(owner, code, weight, len(step))
                empty = np.bincount(owner, minlength=len(step)) == 0
                size = 4 * bagminhash.REGISTERS
                data = pa.Array.from_buffers(pa.binary(size), len(step), [None, pa.py_buffer(sig)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*step.columns[:3], pc.if_else(pa.array(empty), pa.scalar(None, pa.binary()), data)],
                    ["doc", "key", "size", "sig"])

    return rows.mapInArrow(run, f"doc {kind}, key binary, size int, sig binary")


def check(pairs: DataFrame, one: DataFrame, texts: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) of keys, those that are similar enough."""
    left, right = (one.select(F.col("key").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "ab")
    near = agreeing(pairs.join(left, "a").join(right, "b"))
    left, right = (texts.select(F.col("key").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.add(pc.binary_length(batch.column("text_a")), pc.binary_length(batch.column("text_b")))
            # a step ends where the next multiple of STEP_BYTES is passed
            step = np.cumsum(size.to_numpy().astype(np.int64)) // STEP_BYTES
            cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(batch))
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(i, j - i)
                same = bagminhash.similarity(part.column("text_a"), part.column("text_b")) >= LEAST
                yield part.select(["a", "b"]).filter(pa.array(same))

    rows = near.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a binary, b binary")


def agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in at least ``AGREE`` registers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(len(batch), -1)
                           for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(1) >= AGREE))

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def likely(group: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The pairs of a group of two parts (p, q) that the similarity check is for:
    a member and the later ones that agree with it often enough, are of another
    class and the other part, and share no earlier band."""
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(len(group), -1)
    class_ = group.column("class").combine_chunks().dictionary_encode().indices.to_numpy()
    part = group.column("part").to_numpy()
    two, pos = group.column("p")[0] != group.column("q")[0], group.column("pos")[0].as_py()
    for i in range(len(group) - 1):
        other = class_[i + 1:] != class_[i]
        if two:
            other &= part[i + 1:] != part[i]
        j = i + 1 + np.flatnonzero(other)
        same = sig[j] == sig[i]
        enough = same.sum(1) >= AGREE
        j, same = j[enough], same[enough]
        j = j[same[:, :ROWS * BANDS].reshape(len(j), BANDS, ROWS).all(2).argmax(1) == pos]
        if len(j):
            yield i, j


def with_partner(group: pa.Table) -> pa.Table:
    """The members that have a pair to check."""
    use = np.zeros(len(group), bool)
    for i, j in likely(group):
        use[i] = use[j] = True
    return group.filter(pa.array(use))


def linked(group: pa.Table) -> pa.Table:
    """Pairs of classes with a similar pair of texts, as many as join them."""
    owner, code, weight = bagminhash.shingles(group.column("text"))
    number = np.unique(code, return_inverse=True)[1]
    at = np.searchsorted(owner, np.arange(len(group) + 1))
    total = np.add.reduceat(weight, at[:-1])
    class_ = group.column("class").combine_chunks().dictionary_encode()
    root, found = class_.indices.to_numpy().copy(), []
    mine = np.zeros(number.max() + 1, np.int64)
    for i, j in likely(group):
        j = j[root[j] != root[i]]
        if not len(j):
            continue
        mine[number[at[i]:at[i + 1]]] = weight[at[i]:at[i + 1]]
        size = at[j + 1] - at[j]
        begin = np.cumsum(size) - size
        there = np.arange(size.sum()) + np.repeat(at[j] - begin, size)
        shared = np.add.reduceat(np.minimum(mine[number[there]], weight[there]), begin)
        mine[number[at[i]:at[i + 1]]] = 0
        for k in j[shared / (total[i] + total[j] - shared) >= LEAST]:
            if root[k] != root[i]:
                found.append((i, k))
                root[root == root[k]] = root[i]
    a, b = (group.column("class").take(pa.array([x[k] for x in found], pa.int64())) for k in range(2))
    return pa.table({"a": a, "b": b})


def rest(others: DataFrame, one: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that belong together, from all pairs of the members
    besides the hubs (bucket, pos, key, size, class)."""
    mixed = others.groupBy("bucket").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / PART), F.ceil(F.sum("size") / PART_BYTES)).alias("parts"),
        (F.min("class") != F.max("class")).alias("mixed")).filter("mixed").drop("mixed")
    rows = others.drop("size").join(mixed, "bucket")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key", "bucket"), "parts"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = rows.select("bucket", "pos", F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"),
                       "part", "key", "class")
    rows = rows.join(one.select("key", "sig"), "key").select(*rows.columns, "sig")
    rows = cut_lineage(rows.groupBy("bucket", "p", "q").applyInArrow(with_partner, rows.schema))
    return rows.join(texts, "key").groupBy("bucket", "p", "q").applyInArrow(linked, "a binary, b binary").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            carry: tuple[str, ...] | None = None) -> DataFrame:
    """doc, key, id, class (null for a text without words) and class_id (the
    least id of the class) of every row."""
    rows = cut_lineage(signed(docs, text_col, carry or (id_col,)))
    rows = rows.withColumn("id", F.col(f"doc.{id_col}"))
    one = cut_lineage(rows.filter("sig is not null").groupBy("key").agg(
        F.min("id").alias("id"), F.first("size").alias("size"), F.first("sig").alias("sig")))
    size = 4 * ROWS
    bands = one.select("key", "id", "size", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.substring("sig", b * size + 1, F.lit(size)))))
    bands = bands.select("key", "id", "size", "pos", F.xxhash64("pos", "col").alias("bucket"))
    shared = bands.groupBy("bucket").count().filter("count > 1").select("bucket")
    members = cut_lineage(bands.join(shared, "bucket"))
    # the texts that candidates can come from, once each
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.select(F.unhex(F.md5("text")).alias("key"), "text")
    texts = texts.join(members.select("key").distinct(), "key", "left_semi")
    texts = cut_lineage(texts.groupBy("key").agg(F.first("text").alias("text")))
    # copies mostly come after what they copy, so the least id is the hub
    hubs = cut_lineage(members.groupBy("bucket").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"].alias("hub")))
    others = cut_lineage(members.join(hubs, "bucket").filter("key != hub").drop("id"))
    pairs = others.select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
    new = cut_lineage(check(pairs, one, texts))
    found = None
    if not new.isEmpty():
        found = cut_lineage(connected_components(new.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    others = others.drop("hub").withColumn("class", F.col("key"))
    if found is not None:
        known = found.select(F.col("id").alias("key"), "component")
        others = others.join(known, "key", "left").withColumn("class", F.coalesce("component", "key")).drop("component")
    new = cut_lineage(rest(cut_lineage(others), one, texts))
    if not new.isEmpty():
        # classes by classes; a class is named after one of its texts
        more = cut_lineage(connected_components(new.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
        if found is None:
            found = more
        else:
            wider = found.join(more.select(F.col("id").alias("component"), F.col("component").alias("wide")), "component", "left")
            wider = wider.select("id", F.coalesce("wide", "component").alias("component"))
            found = cut_lineage(wider.unionByName(more.join(found.select("id"), "id", "left_anti")))
    if found is None:
        named = one.select("key", F.col("key").alias("class"), F.col("id").alias("class_id"))
    else:
        # classes of several texts; their least id, then one row per text
        several = one.select("key", "id").join(found.withColumnsRenamed({"id": "key"}), "key")
        least = cut_lineage(several.groupBy("component").agg(F.min("id").alias("least")))
        several = cut_lineage(several.join(least, "component").select("key", "component", "least"))
        named = one.select("key", "id").join(several, "key", "left").select(
            "key", F.coalesce("component", "key").alias("class"),
            F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("class_id"))
    # texts without words have no row in ``named``: each is a class of its own
    out = rows.drop("sig", "size").join(cut_lineage(named.withColumnsRenamed({"key": "k"})), F.col("key") == F.col("k"), "left")
    return out.select("doc", "key", "id", "class", F.when(F.col("k").isNull(), F.col("id")).otherwise(
        F.col("class_id")).alias("class_id"))


def one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near duplicates: of each class the row with the
    least id stays (of rows that repeat one); texts without words stay.  The
    texts are not carried along: those that stay are read again by id and key."""
    named = classes(docs, id_col, text_col).filter("class is not null")
    first = named.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("f"))
    first = cut_lineage(first.select(F.col("f.id").alias("id"), F.col("f.key").alias("key")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.filter(worded).select(F.struct("*").alias("doc"), F.unhex(F.md5(text)).alias("k"))
    stay = rows.join(first, (F.col("k") == F.col("key")) & F.col(f"doc.{id_col}").eqNullSafe(F.col("id")), "left_semi")
    again = Window.partitionBy("k", f"doc.{id_col}").orderBy(F.xxhash64("doc"))
    stay = stay.withColumn("n", F.row_number().over(again)).filter("n = 1")
    return stay.select("doc.*").unionByName(docs.filter(~worded))
