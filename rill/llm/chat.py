"""Chat formatting by columnar byte assembly, and reading it back.

Template: every turn is ``<|role|>`` role ``<|text|>`` text ``<|end|>``.  In
roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so the
control strings cannot occur inside them and every text comes back unchanged.
The loss mask holds the byte ranges of the (escaped) texts of assistant turns.

A batch of turns is formatted without a loop over turns: segment lengths give
cumulative offsets, these give scatter indices, and headers and contents are
copied into one buffer allocated once.  A conversation comes out in segments of
about ``SEGMENT`` bytes, cut between turns, with their number and first byte, so
that tasks hold a step of a batch and never a whole conversation.  Its turns meet
in one task, sorted by Spark, because their order and the digests of what is read
back run from its first turn to its last.

Defined cases: a null role or text is empty; rows without conv_id form one
conversation without id; turns that repeat are ordered by role and text, null
turns come first; a conversation without assistant turns has an empty mask;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rill.llm.common import raw, text_steps

# The template's control strings.
ROLE, TEXT, END = b"<|role|>", b"<|text|>", b"<|end|>"
LEARNED = "assistant"
#: Bytes of a segment (the last turn may pass it); text bytes handled at once.
SEGMENT, STEP = 16 << 10, 4 << 20


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), "<|", "<\\|")


def unescape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, "<\\|", "<|"), "\\\\", "\\")


def scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, ends: np.ndarray) -> None:
    """Copy the slices of ``data`` between ``ends`` to the places ``at``."""
    length = np.diff(ends)
    out[np.arange(len(data)) + np.repeat(at - ends[:-1], length)] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns, where each turn ends (from 0), and
    where its text begins and ends."""
    (r_ends, r_data), (t_ends, t_data) = (raw(escape(a).cast(pa.large_binary())) for a in (roles, texts))
    n = len(roles)
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(ROLE), len(TEXT), len(END)
    lengths[:, 1], lengths[:, 3] = np.diff(r_ends), np.diff(t_ends)
    ends = np.cumsum(lengths.reshape(-1)).reshape(n, 5)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for k, mark in ((0, ROLE), (2, TEXT), (4, END)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    scatter(out, starts[:, 1], r_data, r_ends)
    scatter(out, starts[:, 3], t_data, t_ends)
    return out, np.append(0, ends[:, 4]), starts[:, 3], ends[:, 3]


def string(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(ends) - 1, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(data)).cast(pa.string())


def starts_of(keys: pa.Array) -> np.ndarray:
    """Where the groups of equal neighbours begin."""
    if not len(keys):
        return np.zeros(0, np.int64)
    a, b = keys[1:], keys[:-1]
    same = pc.or_(pc.equal(a, b).fill_null(False), pc.and_(a.is_null(), b.is_null()))
    return np.append(0, np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1)


def format_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Per segment of a conversation: ``id_col``, segment (number from 0), start (its
    first byte in the conversation), n_turns, formatted, mask (array of start and
    end, in bytes of the conversation, of what is learned from)."""
    rows = turns.select(F.col(id_col), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    rows = rows.repartition(id_col).sortWithinPartitions(id_col, "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, segments, length = None, 0, 0     # the conversation under way
        for batch in batches:
            for part in text_steps(batch, "text", STEP):
                ids, roles, texts = (part.column(c) for c in (id_col, "role", "text"))
                data, ends, begin, stop = assemble(roles, texts)
                new = starts_of(ids)
                turns = np.diff(np.append(new, len(ids)))
                piece = (ends[:-1] - np.repeat(ends[new], turns)) // SEGMENT
                cut = np.append(True, piece[1:] != piece[:-1])
                cut[new] = True
                first = np.flatnonzero(cut)
                bounds = np.append(first, len(ids))
                owner = np.searchsorted(new, first, side="right") - 1
                shift = -ends[new]              # from bytes of the step to bytes of the conversation
                number = np.arange(len(first)) - np.searchsorted(first, new)[owner]
                if last is not None and last.equals(ids[0]):
                    shift[0] += length
                    number[owner == 0] += segments
                last, segments, length = ids[-1], int(number[-1]) + 1, int(ends[-1] + shift[-1])
                learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
                masks = pa.StructArray.from_arrays(
                    [pa.array((x + np.repeat(shift, turns))[learned], pa.int64()) for x in (begin, stop)], ["start", "end"])
                offsets = np.append(0, np.cumsum(learned))[bounds].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(first)), pa.array(number, pa.int64()), pa.array(ends[first] + shift[owner], pa.int64()),
                     pa.array(np.diff(bounds), pa.int64()), string(data, ends[bounds]),
                     pa.ListArray.from_arrays(pa.array(offsets), masks)],
                    [id_col, "segment", "start", "n_turns", "formatted", "mask"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, segment long, start long, n_turns long, formatted string, "
                                "mask array<struct<start:long,end:long>>")


def read_turns(formatted: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Roles and texts found in formatted conversations, and each
    conversation's first turn."""
    ends, data = raw(formatted.cast(pa.large_binary()))
    marks = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))) if len(data) else np.zeros(0, np.int64)
    role, text, end = (marks[k::3] for k in range(3))
    parts = []
    for a, b in ((role + len(ROLE), text), (text + len(TEXT), end)):
        size = b - a
        stops = np.append(0, np.cumsum(size))
        picked = data[np.arange(stops[-1]) + np.repeat(a - stops[:-1], size)]
        parts.append(unescape(string(picked, stops)))
    return parts[0], parts[1], np.searchsorted(role, ends)


def read_back(formatted: DataFrame, id_col: str = "conv_id", in_order: bool = False) -> DataFrame:
    """What formatted conversations and their masks hold, as counts and digests.
    Sorted segments feed the running digests of the conversation under way; with
    ``in_order`` they come straight from ``format_turns`` and need no sort."""
    kind = formatted.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state, done, last = None, [], None

        def out(id_type: pa.DataType) -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [id_type, *types], strict=True)], names)

        def end() -> None:
            if state is not None:
                done.append((last.as_py(), state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for step in text_steps(batch, "formatted", STEP):
                ids, texts = step.column(id_col), step.column("formatted")
                roles, contents, first = read_turns(texts)
                lines = pc.binary_join_element_wise(roles, contents, "", "\n").cast(pa.large_binary())
                at, said = raw(lines)
                # the text under the masks
                ends, whole = raw(texts.cast(pa.large_binary()))
                spans, counts = step.column("mask").flatten(), step.column("mask").value_lengths().to_numpy()
                owner = np.repeat(ends[:-1] - step.column("start").to_numpy(), counts)
                a, b = (spans.field(k).to_numpy(zero_copy_only=False) + owner for k in ("start", "end"))
                size = (b - a).astype(np.int64)
                stops = np.append(0, np.cumsum(size))
                picked = whole[np.arange(stops[-1]) + np.repeat(a - stops[:-1], size).astype(np.int64)]
                learned = unescape(string(picked, stops))
                chars = np.append(0, np.cumsum(pc.utf8_length(learned).to_numpy(zero_copy_only=False)))
                lost, loss = raw(learned.cast(pa.large_binary()))
                bounds = np.append(0, np.cumsum(counts)).astype(np.int64)
                long = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
                new = set(starts_of(ids).tolist())
                for k in range(len(step)):
                    if k in new and not (k == 0 and last is not None and last.equals(ids[0])):
                        end()
                        state, last = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], ids[k]
                    state[0] += int(first[k + 1] - first[k])
                    state[1].update(said[at[first[k]]:at[first[k + 1]]])
                    state[2] += int(chars[bounds[k + 1]] - chars[bounds[k]])
                    state[3].update(loss[lost[bounds[k]]:lost[bounds[k + 1]]])
                    state[4] += int(long[k])
                if done:
                    yield out(ids.type)
                    done = []
        if state is not None:
            end()
            yield out(last.type)

    rows = formatted.select(id_col, "segment", "start", "formatted", "mask")
    if not in_order:
        rows = rows.repartition(id_col).sortWithinPartitions(id_col, "segment")
    return rows.mapInArrow(
        run, f"`{id_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")
