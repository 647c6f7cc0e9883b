"""User-user co-occurrence over a (user, item) table, in DataFrame operators.

Each (user, item) row meets the list of the item's users; the lists go to the
user's partition, where one aggregate counts how often each other user stands in
them and the best are chosen.  So a pair crosses the network once, as an element
of a list of numbers; counting and ranking need no further exchange.  There
are as many partitions as the number of pairs asks for (``PAIRS`` in each), which
bounds a task's memory whatever the input.

These lists are nearly all that is shuffled, so an element is one number: the
user's distance from the least user id and, in the lowest bits, its item count.
It is an int where the ids' range and the largest count leave room, else a long;
ids that fit neither, or are no integers, travel as pairs.

An item with many users would make rows of any length.  So an item of degree d is
dealt into ``ceil(d / SPLIT)`` parts: each part has a list of its own, and every
part meets all of them.  The score follows from the shared count and both
users' item counts.

With ``stored``, lists of more than ``SLICE_PAIRS`` elements are shuffled in turns, for
one share of the users after the other, whose best are stored before the shuffle files go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rill.session import cut_lineage, release

#: Users in one list of an item, and list elements of one partition.
SPLIT, PAIRS = 2_000, 2_000_000
#: List elements (4 or 8 bytes each) on disk at a time where the best are stored.
SLICE_PAIRS = 1_000_000_000
#: Elements that make a partition worth while, up to the session's number of partitions.
FEW_PAIRS = 50_000


def score_column(kind: str, shared="shared", n1="n1", n2="n2"):
    """The score of a pair as a column."""
    s, a, b = F.col(shared), F.col(n1), F.col(n2)
    if kind == "jaccard":
        return s / (a + b - s)
    if kind == "overlap":           # shared / (n1 * n2): the cross-join draft's ratio
        return s / (a * b)
    if kind == "shared":
        return s.cast("double")
    raise ValueError(kind)


def _packing(rows: DataFrame):
    """How an element of a list is made of ``user`` and ``n``, and both are read from it."""
    kind = rows.schema["user"].dataType
    if isinstance(kind, T.IntegralType):
        low, high, n = rows.agg(F.min("user"), F.max("user"), F.max("n")).first()
        bits = (n or 0).bit_length()
        width = ((high or 0) - (low or 0)).bit_length() + bits
        if width < 64:
            base, size = F.lit(low or 0).cast("long"), "int" if width < 32 else "long"
            return (F.shiftleft(F.col("user").cast("long") - base, bits).bitwiseOR(F.col("n")).cast(size),
                    lambda x: (F.shiftright(x, bits).cast("long") + base).cast(kind),
                    lambda x: x.bitwiseAND(F.lit((1 << bits) - 1).cast(size)).cast("long"))
    return F.struct("user", "n"), lambda x: x["user"], lambda x: x["n"]


def _lists(baskets: DataFrame, user: str, item: str, split: int, both: bool):
    """Every row's user and count ``u1, n1`` with a list of others, a function that counts such
    rows in a number of tasks, and the number of list elements."""
    rows = baskets.select(F.col(user).alias("user"), F.col(item).alias("item")).dropna()
    rows = rows.repartition("user").distinct().withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user")))
    stored = rows = cut_lineage(rows, tidy=True)                    # one exchange, as it is by user already
    pack, user_of, n_of = _packing(rows)
    degrees = cut_lineage(rows.groupBy("item").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), tidy=True)
    d = F.col("d").cast("double")
    pairs, most_users = degrees.agg(F.sum(d * d), F.max("d")).first()
    pairs = int(pairs or 0) // (1 if both else 2)
    hot = (most_users or 0) > split
    if hot:
        parts = degrees.where(F.col("d") > split).select("item", F.ceil(F.col("d") / F.lit(split)).cast("int").alias("parts"))
        rows = rows.join(parts, "item", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    else:
        rows = rows.withColumn("parts", F.lit(1))
    part = F.pmod(F.xxhash64("user"), F.col("parts")).cast("int").alias("part")
    lists = cut_lineage(rows.groupBy("item", "parts", part).agg(F.array_sort(F.collect_list(pack)).alias("all"))
                        .where("parts > 1 OR size(all) > 1"), tidy=True)
    release(stored)
    release(degrees)
    own = lists.select(F.posexplode("all").alias("at", "me"), "all")
    if not both:                                                    # sorted: the greater users are the rest
        own = own.where("at + 1 < size(all)").withColumn("all", F.expr("slice(all, at + 2, size(all))"))
    met = own.select("me", "all")
    if hot:
        wide = lists.where("parts > 1")
        left = wide.select("item", F.col("part").alias("from"), F.col("all").alias("mine"),
                           F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).where("from <> part")
        cross = left.join(wide, ["item", "part"]).select(F.explode("mine").alias("me"), "all")
        met = met.unionByName(cross if both else cross.withColumn("all", F.filter("all", lambda x: x > F.col("me"))))
    met = met.select(user_of(F.col("me")).alias("u1"), n_of(F.col("me")).alias("n1"), "all")

    def count(met: DataFrame, tasks: int) -> DataFrame:
        one = met.repartition(tasks, "u1").select("u1", "n1", F.explode("all").alias("x"))
        one = one.select("u1", user_of(F.col("x")).alias("u2"), "n1", n_of(F.col("x")).alias("n2")).where("u1 <> u2")
        return (one.groupBy("u1", "u2", "n1", "n2").agg(F.count(F.lit(1)).alias("shared"))
                .select("u1", "u2", "shared", "n1", "n2"))

    return met, count, pairs


def _tasks(met: DataFrame, pairs: int) -> int:
    most = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-pairs // PAIRS), min(most, -(-pairs // FEW_PAIRS)))


def _counted(baskets: DataFrame, user: str, item: str, split: int, both: bool) -> DataFrame:
    """``u1, u2, shared, n1, n2``, partitioned by u1, of all pairs in both orders or with u1 < u2."""
    met, count, pairs = _lists(baskets, user, item, split, both)
    return count(met, _tasks(met, pairs))


def unordered_pairs(baskets: DataFrame, user: str = "user_id", item: str = "item_id", *,
                    split: int = SPLIT) -> DataFrame:
    """``u1, u2, shared, n1, n2`` for every pair ``u1 < u2`` of users that
    share an item; ``n1``/``n2`` are the users' distinct item counts."""
    return _counted(baskets, user, item, split, both=False)


def co_occurrence(baskets: DataFrame, user: str = "user_id", item: str = "item_id", *,
                  split: int = SPLIT) -> DataFrame:
    """The same pairs in both orders (u1 != u2)."""
    return _counted(baskets, user, item, split, both=True)


def top_k_similar(baskets: DataFrame, user: str = "user_id", item: str = "item_id", *,
                  k: int = 3, score: str = "jaccard", rank_fn: str = "row_number",
                  stored: bool = False, split: int = SPLIT) -> DataFrame:
    """Each user's ``k`` most similar users.

    Columns ``u1, u2, shared, n1, n2, all_cnt, sim, sim_rank``; order is
    score descending then ``u2`` ascending (ties broken by the smaller id).
    ``stored`` finds them at once where one shuffle of all lists would be too
    large; without it a filter on ``u1`` still reaches the lists.
    """
    met, count, pairs = _lists(baskets, user, item, split, both=True)
    sim = score_column(score)
    fn = {"row_number": F.row_number, "rank": F.rank}[rank_fn]
    order = [F.col("sim").desc()] + ([F.col("u2").asc()] if rank_fn == "row_number" else [])
    w = Window.partitionBy("u1").orderBy(*order)

    def best(met: DataFrame, pairs: int) -> DataFrame:
        return (count(met, _tasks(met, pairs))
                .withColumn("all_cnt", F.col("n1") + F.col("n2") - F.col("shared"))
                .withColumn("sim", sim)
                .withColumn("sim_rank", fn().over(w))
                .where(F.col("sim_rank") <= k))

    turns = -(-pairs // SLICE_PAIRS) if stored else 1
    if turns <= 1:
        return best(met, pairs)
    turn = F.pmod(F.xxhash64("u1"), F.lit(turns))
    return reduce(DataFrame.unionByName, [
        cut_lineage(best(met.where(turn == t), pairs // turns), tidy=True) for t in range(turns)])


def top_pairs(baskets: DataFrame, user: str = "user_id", item: str = "item_id", *,
              k: int = 10, **kw) -> DataFrame:
    """M7: the ``k`` ordered user pairs with the most shared items
    (ties: smaller u1, then smaller u2)."""
    # the first k pairs in either order come from the first k with u1 < u2
    half = unordered_pairs(baskets, user, item, **kw).orderBy(F.col("shared").desc(), "u1", "u2").limit(k)
    both = F.explode(F.array(F.struct("u1", "u2", "shared"),
                             F.struct(F.col("u2").alias("u1"), F.col("u1").alias("u2"), "shared")))
    cand = half.select(both.alias("p")).select("p.*")          # counted once, unlike a union with itself
    return (cand.orderBy(F.col("shared").desc(), "u1", "u2").limit(k)
            .select("u1", "u2", F.col("shared").alias("common_cnt")))
