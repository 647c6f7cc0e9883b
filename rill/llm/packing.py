"""Best-fit packing of token sequences by minimum bin slack.

1. Every document is tokenised once (equal white-space chunks of a batch once)
   and cut into pieces: full ones of ``capacity`` tokens where it is longer,
   and the rest.  The pieces (ids as a checksum, not as text) are stored.
2. What matters for packing is only how many pieces have each length: a table
   of at most ``capacity`` rows, whatever the input.  Per bin, the longest
   piece left is set and a subset-sum dynamic programme over a bitset of
   reachable fills finds the fullest combination of the lengths available.  The
   same combination is then taken as often as the counts allow, so there are
   about as many different patterns as lengths, not as bins.
3. Pieces of a length are numbered without a sort: a running number within
   each writing task, plus the numbers of the tasks before it (one row per
   task and length).  Ranges of numbers belong to patterns; a binary search
   gives each piece its bin and place.

No group of pieces meets in one task, so a length (or a group of copies) that
holds a third of all rows does no harm.

Defined cases: a null or empty text is one piece that holds the end token; a
null id stays null; rows that repeat are packed each on their own; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rill.llm.common import LOWER, plain_text, raw, shared_bytes, text_steps, to_binary
from rill.session import cut_lineage

#: Words that a worker remembers (then it starts afresh), and words to a call.
REMEMBERED, GROUP = 400_000, 500
#: Text bytes handled at once; a worker takes up to twenty times as much for them.
STEP_BYTES = 8 << 20


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """As ``chunks``, for a tokenizer that drops white space and reads capital
    letters as small ones: ASCII letters are made small, the blank before a
    chunk is left out, and a full stop or comma after an ASCII letter starts a
    chunk of its own, as it is a word of its own."""
    ends, data = raw(plain_text(texts))
    if not len(data):
        return to_binary(np.zeros(1, np.int64), data), np.zeros(len(texts) + 1, np.int64)
    if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():     # special tokens keep their case
        data = LOWER[data]
    blank = (data == 32) | (data == 10)
    sure = (data > 32) & (data < 127)
    sure[1:] |= (data[1:] >= 128) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    letter = (data >= 97) & (data <= 122)
    cut = np.zeros(len(data), bool)
    cut[1:] = blank[1:] & sure[:-1] | ((data[1:] == ord(".")) | (data[1:] == ord(","))) & letter[:-1]
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    at = np.flatnonzero(cut)
    before = np.searchsorted(at, ends)
    gone = blank[at]                            # at most one byte of each chunk
    stay = np.ones(len(data), bool)
    stay[at[gone]] = False
    at = at - (np.cumsum(gone) - gone)
    return to_binary(np.append(at, len(data) - gone.sum()), data[stay]), before


class LibraryTokens:
    """Ids from the tokenizers library.  Equal words of a batch are looked up
    once; new ones are encoded many to a call, set apart by blanks, and told
    apart by the end-of-word mark of their last token."""

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def one(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        out, plain, texts = {}, [], []
        for w in new:
            text = str(w, "utf-8", "replace")
            if text.isalpha():                  # one word to the tokenizer, too
                plain.append(w)
                texts.append(text)
            else:
                out[w] = self.one(text)
        for i in range(0, len(plain), GROUP):
            group = plain[i:i + GROUP]
            encoding = self.tokenizer.encode(" ".join(texts[i:i + GROUP]), add_special_tokens=False)
            ids = np.array(encoding.ids, "<u4")
            at = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(at) != len(group):           # letters that fall apart when made small
                out.update((w, self.one(str(w, "utf-8", "replace"))) for w in group)
                continue
            data, first = ids.tobytes(), 0
            for w, last in zip(group, at.tolist(), strict=True):
                out[w] = data[first:last]
                first = last
        return out

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The chunks' ids (32-bit little-endian) and each text's first chunk."""
        cut, before = words(texts)
        coded = cut.dictionary_encode()
        keys = coded.dictionary.to_pylist()
        known = self.known
        fresh = self.learn([w for w in keys if w not in known])
        ids = pa.array([fresh[w] if w in fresh else known[w] for w in keys], pa.large_binary())
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
        known.update((k, v) for k, v in fresh.items() if len(k) < 64)
        return ids.take(coded.indices), before


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, piece, start, length, ids_crc32 and, for numbering, task and
    number (among the task's pieces of that length)."""
    file = shared_bytes(docs.sparkSession, path)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = LibraryTokens(file.value)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            for step in text_steps(batch, limit=STEP_BYTES):
                ids, before = tokens(step.column("text"))
                at = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1][before] if len(ids) else before
                data = memoryview(ids.buffers()[2] or b"") if len(ids) else memoryview(b"")
                length = np.diff(at) // 4 + 1
                parts = -(-length // capacity)
                row = np.repeat(np.arange(len(length)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                size = np.minimum(length[row] - start, capacity)
                first = at[row] + 4 * start
                crc = [zlib.crc32(data[a:b]) for a, b in
                       zip(first.tolist(), np.minimum(first + 4 * size, at[row + 1]).tolist(), strict=True)]
                for i in np.flatnonzero(piece == parts[row] - 1).tolist():
                    crc[i] = zlib.crc32(last, crc[i])
                order = np.argsort(size, kind="stable")
                ranked = size[order]
                run_start = np.searchsorted(ranked, ranked)
                number = np.empty(len(size), np.int64)
                number[order] = np.arange(len(size)) - run_start + seen[ranked]
                seen += np.bincount(size, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [step.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(size), task), pa.int32()), pa.array(number, pa.int64())],
                    [id_col, "piece", "start", "length", "ids_crc32", "task", "number"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, "
                                "task int, number long")


def fullest(left: dict[int, int], room: int) -> Counter:
    """The combination of available lengths with the largest sum up to ``room``."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    full = 1 << room
    for length in sorted((x for x in left if x <= room), reverse=True):
        for _ in range(min(left[length], room // length)):
            steps.append((length, reach))
            wider = (reach | reach << length) & mask
            if wider == reach:
                steps.pop()
                break
            reach = wider
            if reach & full:
                break
        if reach & full:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        if not before >> at & 1:                # this fill needed the length
            chosen[length] += 1
            at -= length
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length: how often in a bin) and how many bins follow each."""
    left = {k: v for k, v in counts.items() if v}
    patterns = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        bin_ = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        bin_[longest] += 1
        times = min(left[k] // n for k, n in bin_.items())
        patterns.append((dict(bin_), times))
        for k, n in bin_.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return patterns


class Places:
    """Which bin and offset the n-th piece of each length gets."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]]):
        given: Counter = Counter()
        rows, bins = [], 0
        for bin_, times in patterns:
            offset = 0
            for length, n in sorted(bin_.items(), reverse=True):
                rows.append((length, given[length], n, bins, offset))
                given[length] += n * times
                offset += n * length
            bins += times
        rows.sort()
        self.length, self.first, self.per_bin, self.bin, self.offset = (
            np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [()] * 5))

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scale = np.int64(max(int(self.first.max(initial=0)), int(number.max(initial=0))) + 1)
        at = np.searchsorted(self.length * scale + self.first, length * scale + number, side="right") - 1
        copy, slot = np.divmod(number - self.first[at], self.per_bin[at])
        return self.bin[at] + copy, self.offset[at] + slot * length


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and place: ``id_col``, piece, start,
    length, ids_crc32, sequence_id, offset."""
    cut = cut_lineage(pieces(docs, path, capacity, end_id, id_col, text_col))
    tasks = cut.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = Places(plan(counts, capacity))
    numbered = cut.join(tasks, ["length", "task"]).withColumn("number", F.col("number") + F.col("base"))
    numbered = numbered.select(id_col, "piece", "start", "length", "ids_crc32", "number")
    schema = (f"`{id_col}` {numbered.schema[id_col].dataType.simpleString()}, piece int, start long, length long, "
              "ids_crc32 long, sequence_id long, offset long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bin_, offset = places(*(b.column(c).to_numpy() for c in ("length", "number")))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(bin_), pa.array(offset)],
                                             [*b.schema.names[:5], "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)
