"""Periodic runs of words: difference-cover LCE and harmonic-grid enumeration.

A run is a stretch of words with smallest period q and length >= max(LEAST, 2q)
that no neighbouring word extends keeping period q.  The texts of a step are one
row of word numbers, each text closed by a number that occurs once, so nothing
matches across texts.

1. ``Extensions`` answers longest common extensions.  It sorts only the suffixes
   whose place modulo 31 is in a difference cover of six residues: first by their
   31 words, then by doubling over blocks of 31, which stay inside the sample.
   The common prefixes of neighbours in that order come from the same ranks, and a
   sparse table gives their minimum between any two.  For two places i and j there
   is a shift below 31 that brings both into the sample: the words before it are
   compared, the rest is one look-up.
2. A run of period q holds a grid place i with equal words at i and i + q; places
   q apart are enough (12 - q for small q, since a run has 12 words), in all
   n ln n of them.  Longest extensions forwards from there, and backwards on the
   mirrored row, give the run's ends.
3. A stretch found with several periods has the least one.

``drop`` marks the words of each run after its first period.

Memory per word of a step is about 200 bytes; texts are taken together up to
``STEP_BYTES``, and a longer single text is a step of its own.

Defined cases: a null or empty text has no word, no run and an empty collapsed
text; rows that repeat give equal rows; an empty table gives no rows; the input's
columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.llm.common import plain_text, raw, text_steps, to_binary

LEAST = 12
#: Every difference modulo 31 is one of two members of the cover.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Grid places that are followed up together.
PLACES = 1 << 18
STEP_BYTES = 2 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def shifts() -> np.ndarray:
    """[i mod 31, j mod 31] -> least shift that brings both into the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    i, j, s = np.ix_(*[np.arange(MODULUS)] * 3)
    return (inside[(i + s) % MODULUS] & inside[(j + s) % MODULUS]).argmax(2)


SHIFT = shifts()


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, first byte and byte length of every word, and each text's first
    word (one more entry closes the last)."""
    ends, data = raw(plain_text(texts))
    inside = ~_BLANK[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(data)]
    start[first] = inside[first]
    at = np.flatnonzero(start)
    place = np.cumsum(inside)
    size = np.diff(np.append(place[at], place[-1] + 1 if len(data) else 1)) if len(at) else np.zeros(0, np.int64)
    bytes_ = to_binary(np.append(np.cumsum(size) - size, size.sum()), data[inside]).dictionary_encode()
    return bytes_.indices.to_numpy().astype(np.int64), at, size, np.searchsorted(at, ends)


class Extensions:
    """Longest common extensions of a row of numbers that ends with one that
    occurs nowhere else."""

    def __init__(self, x: np.ndarray):
        self.n = len(x)
        self.x = np.concatenate([x + 1, np.zeros(2 * MODULUS, np.int64)])     # 0 is beyond the end
        self.rank = None

    def build(self) -> None:
        n, v = self.n, MODULUS
        sample = np.flatnonzero(np.isin(np.arange(n) % v, COVER))
        bits = max(1, int(self.x.max()).bit_length())
        each = max(1, 62 // bits)
        keys = []
        for a in range(0, v, each):
            key = np.zeros(len(sample), np.int64)
            for k in range(a, min(a + each, v)):
                key = (key << bits) | self.x[sample + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        del keys
        slot = np.zeros(n + 2 * v, np.int64)        # place -> number of its sample
        slot[sample] = np.arange(len(sample))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        levels, width = [rank], v
        while rank.max(initial=0) + 1 < len(sample):    # ends: the last number occurs once
            there = sample + width
            second = np.where(there < n, rank[slot[np.minimum(there, n)]] + 1, 0)
            order = np.lexsort((second, rank))
            a, b = rank[order], second[order]
            new = np.zeros(len(order), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new)
            levels.append(rank)
            width *= 2
        self.slot, self.rank = slot, rank
        # common prefixes of neighbours: whole blocks by the levels, then words
        i, j = sample[order[:-1]], sample[order[1:]]
        length = np.zeros(len(i), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            a, b = i + length, j + length
            fits = (a < n) & (b < n)
            same = fits & (levels[level][slot[np.minimum(a, n)]] == levels[level][slot[np.minimum(b, n)]])
            length[same] += v << level
        on = np.arange(len(i))
        for _ in range(v):
            on = on[self.x[i[on] + length[on]] == self.x[j[on] + length[on]]]
            if not len(on):
                break
            length[on] += 1
        table = [length.astype(np.int32)]
        while 2 << (len(table) - 1) <= len(length):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal numbers from the places i and j (different ones) on."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        on, reached = np.arange(len(i)), []
        for t in range(MODULUS):
            done = shift[on] == t
            reached.append(on[done])
            on = on[~done]
            on = on[self.x[i[on] + t] == self.x[j[on] + t]]
            if not len(on):
                break
            out[on] = t + 1
        on = np.concatenate(reached)
        on = on[(i[on] + shift[on] < self.n) & (j[on] + shift[on] < self.n)]
        if len(on):
            if self.rank is None:
                self.build()
            a, b = (self.rank[self.slot[p[on] + shift[on]]] for p in (i, j))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype("f8"))[1] - 1
            for k in np.unique(level):
                m = level == k
                out[on[m]] += np.minimum(self.table[k][low[m]], self.table[k][high[m] - (1 << k)])
        return out


def runs(x: np.ndarray, longest: np.ndarray, places: int = PLACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, end and smallest period of every run of a row of texts, each
    closed by a number of its own; ``longest`` gives, per period, where the row
    of texts with two periods ends (texts are sorted by falling length)."""
    n = len(x)
    ahead, back = Extensions(x), Extensions(np.append(x[-2::-1], x[-1])) if n > 1 else None
    found, waiting, count = [np.zeros((3, 0), np.int64)], [], 0

    def follow() -> None:
        i, q = (np.concatenate(p) for p in zip(*waiting, strict=True))
        on = ahead(i, i + q)
        # the mirror image of place p is n - 2 - p; a place before the first has none
        before = i > 0
        left = np.zeros(len(i), np.int64)
        left[before] = back(n - 1 - i[before], n - 1 - i[before] - q[before])
        start, end = i - left, i + q + on
        long = end - start >= np.maximum(LEAST, 2 * q)
        rows = np.stack([start[long], end[long], q[long]])
        found.append(np.unique(rows, axis=1))

    for q in range(1, len(longest)):
        end = longest[q]
        step = max(q, LEAST - q)
        i = np.flatnonzero(x[:end - q:step] == x[q:end:step]) * step
        if len(i):
            waiting.append((i, np.full(len(i), q)))
            count += len(i)
        if count > places:
            follow()
            waiting, count = [], 0
    if waiting:
        follow()
    start, end, q = np.concatenate(found, 1)
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.ones(len(q), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[first], end[first], q[first]


def text_runs(number: np.ndarray, at: np.ndarray,
              places: int = PLACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word, end and period of the runs of all texts, by text, first
    word and period; ``at`` gives each text's first word."""
    size = np.diff(at)
    texts = len(size)
    order = np.argsort(-size, kind="stable")
    begin = np.zeros(texts, np.int64)                   # in the row: falling length, one closing number each
    begin[order] = np.cumsum(size[order] + 1) - size[order] - 1
    x = np.empty(len(number) + texts, np.int64)
    owner = np.repeat(np.arange(texts), size)
    x[begin[owner] + np.arange(len(number)) - at[owner]] = number
    base = int(number.max(initial=0)) + 1
    x[begin + size] = base + np.arange(texts)
    # texts with at least max(LEAST, 2q) words, per period
    enough = np.maximum(LEAST, 2 * np.arange(int(size.max(initial=0)) // 2 + 1))
    count = np.searchsorted(-size[order], -enough, side="right")
    ends = np.append(0, np.cumsum(size[order] + 1))[count]
    if len(enough) < 2 or not count[1]:
        return (np.zeros(0, np.int64),) * 4
    # the longest texts alone matter to the largest periods; the others to none
    used = int(ends[1])
    start, end, q = runs(x[:used], ends[: int((count > 0).sum())], places)
    near = np.searchsorted(begin[order], start, side="right") - 1
    text = order[near]
    start, end = start - begin[text], end - begin[text]
    by = np.lexsort((q, start, text))
    return text[by], start[by], end[by], q[by]


def drop(text: np.ndarray, start: np.ndarray, end: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which words some run holds after its first period."""
    edge = np.zeros(at[-1] + 1, np.int64)
    np.add.at(edge, at[text] + start + q, 1)
    np.add.at(edge, at[text] + end, -1)
    return np.cumsum(edge[:-1]) > 0


def joined(data: np.ndarray, first: np.ndarray, size: np.ndarray, keep: np.ndarray, at: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one space."""
    before = np.append(0, np.cumsum(keep))
    lead = before[at[:-1]]                              # number of the text's first kept word
    first, size = first[keep], size[keep]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(before[at]))
    blank = (np.arange(len(first)) > lead[owner]).astype(np.int64)
    ends = np.cumsum(size + blank)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(ends - size, size) + inside] = data[np.repeat(first, size) + inside]
    offsets = np.append(0, ends)[before[at]]
    return to_binary(offsets, out).cast(pa.large_string()).cast(pa.string())


def find(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("*",), step_bytes: int = STEP_BYTES,
         places: int = PLACES) -> DataFrame:
    """doc (struct), n_words, runs (array of start, length, period, by start, then
    period) and collapsed (the text without the repeats in runs) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*carry).alias("doc"), text.alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch, limit=step_bytes):
                number, first, size, at = words(step.column("text"))
                owner, start, end, q = text_runs(number, at, places)
                _, data = raw(plain_text(step.column("text")))
                collapsed = joined(data, first, size, ~drop(owner, start, end, q, at), at)
                lists = pa.StructArray.from_arrays([pa.array(a) for a in (start, end - start, q)], fields=list(run_type))
                offsets = pa.array(np.searchsorted(owner, np.arange(len(step) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc"), pa.array(np.diff(at)), pa.ListArray.from_arrays(offsets, lists), collapsed],
                    ["doc", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(
        run, f"doc {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The runs as number, longest run and digests, beside the columns of doc."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc.*", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.withColumns({"start": start, "length": length, "period": period,
                             "exponent_milli": F.expr("1000 * best.length div -best.period")}).drop("best")
