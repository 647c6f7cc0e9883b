"""Phrase collocations by stripes.

A stripe belongs to a language and a prefix of 0 to 3 words: a counter of the
words that follow the prefix inside a piece of text.  Tasks count stripes of a few
MB of text, Spark brings equal keys together in order, and stripes of a key are
added up element by element.  The merged stripes give

* extensions: prefix + word with its count, the phrases of one word more;
* prefix totals: a prefix is itself an extension of the stripe of one word less,
  and that stripe's counter holds its total, which the cuts of longer phrases need;
* subsumption maxima: a stripe's largest count is that of the phrase's most
  frequent extension to the right; the phrases without their first word give
  those to the left.  (An extension by two words is no more frequent than one of
  the extensions by one word that lie between.)

One pass over the texts per length of prefix.  A phrase with ``least`` occurrences
has only parts with as many, so a pass counts a word after a prefix only if the
prefix, and the prefix's last words with the word, were found frequent by the pass
before.  These are looked up in a bit array of fixed size (``FILTER_BITS``); chance
hits cost room and never change a count.

Wide stripes are dealt into parts by their words' hashes: the empty prefix into
``ROOT_PARTS``, and prefixes of words that are more than 1 in ``HOT`` of all words
(fewer than ``HOT`` of them, by counting) in proportion to their rarest word.

Defined cases: a null text is empty, a null language is ``und``; a text without
words adds nothing; rows that repeat count again; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.llm.common import LOWER, plain_text, raw, text_steps, to_binary
from rill.operators.sorting import add_row_index
from rill.session import cut_lineage

MOST_WORDS = 4
STEP_BYTES = 4 << 20
#: Bits of the array of frequent parts (8 MB).
FILTER_BITS = 1 << 26
ROOT_PARTS, HOT = 512, 1024
_BITMAP = 8 * 4096                      # bits of one of Spark's bitmaps
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CUT, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(10, 14)]] = True
_BLANK[[32, 9]] = True
STRIPE = "lang string, prefix string, part int, words array<string>, counts array<long>"


def hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its language and first words, and the next word's."""
    x = (left ^ (left >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + right + _ODD
    return (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Number of every word, the different words, whether a word follows in the
    same piece, and each word's text."""
    ends, data = raw(plain_text(texts))
    data = LOWER[data]
    cut = _CUT[data]
    inside = ~(cut | _BLANK[data])
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(data)]
    start[first] = inside[first]
    at = np.flatnonzero(start)
    owner = np.searchsorted(ends, at, side="right") - 1
    piece = np.cumsum(cut)[at] if len(at) else at
    follows = np.zeros(len(at), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    place = np.cumsum(inside) - 1
    bounds = np.append(place[at], inside.sum())
    coded = to_binary(bounds, data[inside]).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string()).cast(pa.string()), follows, owner


def named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers for keys, and where each number is first met."""
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return number, first


class Counter:
    """Counts the stripes of the texts of one step; ``hot`` gives the parts of the
    stripes of hot words by their hash."""

    def __init__(self, lang: pa.Array, texts: pa.Array, hot: dict[int, int], root_parts: int = ROOT_PARTS):
        self.word, self.words, follows, owner = tokens(texts)
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy().astype(np.int64)[owner]
        self.follows = follows
        self.hash = hashes(self.words)
        self.lang_hash = hashes(self.langs)
        self.hot, self.root_parts = hot, root_parts

    def stripes(self, at: np.ndarray, width: int) -> pa.RecordBatch:
        """Stripes of the prefixes of ``width`` words that begin at the places
        ``at``, each with the word after it."""
        size = len(self.words)
        key, bound = self.lang[at], len(self.langs)
        for k in range(width + 1):
            if bound * size >= 1 << 62:
                key, first = named(key)
                bound = len(first)
            key = key * size + self.word[at + k]
            bound *= size
        key, first, count = np.unique(key, return_index=True, return_counts=True)
        prefix = key // size                                # sorted, as the keys are
        there = at[first]
        lang, members, following = self.lang[there], [self.word[there + k] for k in range(width)], self.word[there + width]
        parts = self.parts(lang, members) if width else np.full(len(key), self.root_parts)
        part = (self.hash[following] >> np.uint64(8)).astype(np.int64) % parts
        if parts.max(initial=1) > 1:
            order = np.lexsort((part, prefix))
            lang, prefix, following, part, count = lang[order], prefix[order], following[order], part[order], count[order]
            members = [m[order] for m in members]
        new = np.ones(len(prefix), bool)
        new[1:] = (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        offsets = pa.array(np.append(begin, len(prefix)).astype(np.int32))
        text = [self.words.take(pa.array(m[begin])) for m in members]
        text = pc.binary_join_element_wise(*text, " ") if text else pa.array([""] * len(begin), pa.string())
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(lang[begin])), text, pa.array(part[begin].astype(np.int32)),
             pa.ListArray.from_arrays(offsets, self.words.take(pa.array(following))),
             pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int64)))],
            ["lang", "prefix", "part", "words", "counts"])

    def parts(self, lang: np.ndarray, members: list[np.ndarray]) -> np.ndarray:
        """Parts of the stripes of prefixes: what their rarest word asks for."""
        if not self.hot:
            return np.ones(len(lang), np.int64)
        codes = np.fromiter(self.hot, np.uint64, len(self.hot))
        order = np.argsort(codes)
        codes, many = codes[order], np.fromiter(self.hot.values(), np.int64, len(codes))[order]
        least = np.full(len(lang), many.max())
        for m in members:
            code = chained(self.lang_hash[lang], self.hash[m])
            there = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            least = np.minimum(least, np.where(codes[there] == code, many[there], 1))
        return least

    def likely(self, bits: np.ndarray, width: int) -> np.ndarray:
        """Places where a phrase of ``width`` words begins that may be frequent."""
        on = np.ones(len(self.word), bool)
        code = self.lang_hash[self.lang]
        for k in range(width):
            if k:
                on[:-k] &= self.follows[k - 1:-1]
                on[-k:] = False
            code = chained(code, np.roll(self.hash[self.word], -k))
        return on & held(bits, code)


def held(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    place = (code % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def counted(docs: DataFrame, width: int, bits=None, hot=None, root_parts: int = ROOT_PARTS,
            step_bytes: int = STEP_BYTES) -> DataFrame:
    """The tasks' stripes of prefixes of ``width`` words, equal keys together in
    order.  ``bits`` is a broadcast of the frequent phrases of ``width`` words."""
    spread = hot.value if hot else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch, limit=step_bytes):
                c = Counter(step.column("lang"), step.column("text"), spread, root_parts)
                at = np.arange(len(c.word))
                if width:
                    # the phrases of ``width`` words here and one word on may be frequent
                    fine = c.likely(bits.value, width)
                    both = fine[:-1] & fine[1:]
                    at = np.flatnonzero(both & c.follows[:-1] if width == 1 else both)
                if len(at):
                    yield c.stripes(at, width)

    key = ("lang", "prefix", "part")
    return docs.mapInArrow(run, STRIPE).repartition(*key).sortWithinPartitions(*key)


def folded(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows in order of their keys with the stripes of each key added up."""
    new = np.ones(len(rows), bool)
    for name in ("lang", "prefix", "part"):
        c = rows.column(name)
        differs = pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = differs if name == "lang" else new[1:] | differs
    key = np.cumsum(new) - 1
    lists = rows.column("words")
    key = np.repeat(key, lists.value_lengths().to_numpy())
    coded = lists.flatten().dictionary_encode()
    size = max(1, len(coded.dictionary))
    entry = key * size + coded.indices.to_numpy()
    order = np.argsort(entry, kind="stable")
    entry = entry[order]
    first = np.ones(len(entry), bool)
    first[1:] = entry[1:] != entry[:-1]
    begin = np.flatnonzero(first)
    count = np.add.reduceat(rows.column("counts").flatten().to_numpy()[order], begin) if len(begin) else np.zeros(0, np.int64)
    entry = entry[begin]
    offsets = pa.array(np.searchsorted(entry, np.arange(new.sum() + 1) * size).astype(np.int32))
    there = rows.take(pa.array(np.flatnonzero(new)))
    return pa.RecordBatch.from_arrays(
        [*there.columns[:3], pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(entry % size))),
         pa.ListArray.from_arrays(offsets, pa.array(count))], rows.schema.names)


def pruned(rows: pa.RecordBatch, least: int) -> pa.RecordBatch:
    """Sum, largest extension (0 if none is frequent) and frequent extensions."""
    lists, count = rows.column("words"), rows.column("counts").flatten().to_numpy()
    word = lists.flatten()
    size = lists.value_lengths().to_numpy()
    owner = np.repeat(np.arange(len(rows)), size)
    total = np.zeros(len(rows), np.int64)
    np.add.at(total, owner, count)
    use = count >= least
    most = np.zeros(len(rows), np.int64)
    np.maximum.at(most, owner[use], count[use])
    offsets = pa.array(np.searchsorted(owner[use], np.arange(len(rows) + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [rows.column("lang"), rows.column("prefix"), pa.array(total), pa.array(most),
         pa.ListArray.from_arrays(offsets, word.take(pa.array(np.flatnonzero(use)))),
         pa.ListArray.from_arrays(offsets, pa.array(count[use]))],
        ["lang", "prefix", "total", "most", "words", "counts"])


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """One row per part of a stripe: its sum, largest extension and frequent extensions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None                     # the last key so far, which may go on
        for batch in batches:
            if not len(batch):
                continue
            if kept is not None:
                batch = pa.concat_batches([kept, batch.cast(kept.schema)])
            rows = folded(batch)
            if len(rows) > 1:
                yield pruned(rows[:-1], least)
            kept = folded(rows[-1:])
        if kept is not None:
            yield pruned(kept, least)

    return stripes.mapInArrow(run, "lang string, prefix string, total long, most long, words array<string>, counts array<long>")


def extensions(stripes: DataFrame) -> DataFrame:
    """lang, prefix, phrase and a (its count) of all frequent extensions."""
    each = stripes.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    phrase = F.when(F.col("prefix") == "", F.col("e.words")).otherwise(F.concat_ws(" ", "prefix", "e.words"))
    return each.select("lang", "prefix", phrase.alias("phrase"), F.col("e.counts").alias("a"))


def frequent_bits(phrases: DataFrame, size: int = FILTER_BITS):
    """Broadcast of ``size`` bits with those of the phrases' hashes set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = hashes(batch.column("lang")) if len(batch) else np.zeros(0, np.uint64)
            split = pc.split_pattern(batch.column("phrase"), " ")
            count = split.value_lengths().to_numpy()
            word, at = hashes(split.flatten()), np.cumsum(count) - count
            for k in range(int(count.max(initial=0))):
                on = count > k
                code[on] = chained(code[on], word[at[on] + k])
            yield pa.RecordBatch.from_arrays([pa.array((code % np.uint64(size)).astype(np.int64))], ["place"])

    place = F.col("place") + 1                         # Spark's bitmaps count from 1
    rows = phrases.select("lang", "phrase").mapInArrow(run, "place long").groupBy(
        F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    bits = np.zeros(-(-size // _BITMAP) * _BITMAP // 8, np.uint8)
    for r in rows.collect():                            # ``size`` bits at most
        a = (r["bucket"] - 1) * _BITMAP // 8
        bits[a:a + _BITMAP // 8] = np.frombuffer(r["bits"], np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(bits[:size // 8])


def hot_words(words: DataFrame, total: int, hot: int = HOT):
    """Broadcast of parts by hash of the words that are at least 1 in ``hot`` of
    all, so no more than ``hot`` of them."""
    rows = words.filter(F.col("a") * hot >= total).select("lang", "phrase", "a").collect() if total else []
    code = chained(hashes(pa.array([r["lang"] for r in rows], pa.string())),
                   hashes(pa.array([r["phrase"] for r in rows], pa.string()))) if rows else []
    return words.sparkSession.sparkContext.broadcast({int(c): int(r["a"] * hot // total) for c, r in zip(code, rows, strict=True)})


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30,
                 filter_bits: int = FILTER_BITS, root_parts: int = ROOT_PARTS, hot: int = HOT,
                 step_bytes: int = STEP_BYTES) -> DataFrame:
    """lang, phrase, k, a, l, r, n and score of all candidates that no longer one
    subsumes (at 80 percent of their count)."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    one = cut_lineage(merged(counted(texts, 0, root_parts=root_parts, step_bytes=step_bytes), least))
    size = cut_lineage(one.groupBy("lang").agg(F.sum("total").alias("n")))
    frequent = cut_lineage(extensions(one))
    spread = hot_words(frequent, size.agg(F.sum("n")).first()[0] or 0, hot)
    stripes, totals = None, frequent
    for width in range(1, MOST_WORDS):
        bits = frequent_bits(frequent, filter_bits)
        level = cut_lineage(merged(counted(texts, width, bits, spread, step_bytes=step_bytes), least))
        frequent = extensions(level)
        stripes = level if stripes is None else stripes.unionByName(level)
        if width < MOST_WORDS - 1:
            totals = totals.unionByName(frequent)
    found = cut_lineage(extensions(stripes).withColumn("w", F.split("phrase", " ")))
    totals = cut_lineage(totals.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    right = stripes.where("most > 0").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("most").alias("most"))
    left = found.groupBy("lang", F.array_join(F.slice("w", 2, MOST_WORDS), " ").alias("phrase")).agg(F.max("a").alias("most"))
    longer = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = found.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(F.col("most").cast("decimal(20,0)") * 5 < F.col("a").cast("decimal(20,0)") * 4, F.lit(True)))
    cuts = kept.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, MOST_WORDS), " ").alias("right"))
    first = totals.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    rest = totals.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(first, ["lang", "left"]).join(rest, ["lang", "right"]).withColumn("score", F.expr(
        "(2000000 * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
    best = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("m"))
    return best.join(size, "lang").select("lang", "phrase", "m.k", "a", "m.l", "m.r", "n", "m.score")


def best_of_each(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language with their rank.  All phrases
    are sorted over all tasks and numbered; a language of most rows is no group."""
    rows = add_row_index(cut_lineage(found), ["lang", F.desc("score"), F.desc("a"), "phrase"], name="at")
    rows = cut_lineage(rows)
    begin = rows.groupBy("lang").agg(F.min("at").alias("begin"))
    ranked = rows.join(begin, "lang").withColumn("rank", F.col("at") - F.col("begin") + 1).filter(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
