"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once inside a task; bounds a worker's memory.
STEP_BYTES = 16 << 20
#: Capital letters of ASCII read as small ones.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_bytes(spark: SparkSession, path: str):
    """Broadcast a vocabulary file (a fixed file of a few MB, read once by the
    driver), so that executors need no copy of it at the same path."""
    size = os.path.getsize(path)
    if size > 64 << 20:
        raise ValueError(f"{path}: {size} bytes is no vocabulary file")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def fold(doc_id: Column, folds: int = 3) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def text_steps(batch: pa.RecordBatch, column: str = "text",
               limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose texts have about ``limit`` bytes together (a
    longer single text is a slice of its own)."""
    text = batch.column(column)
    if len(text) == 0:
        return
    ends = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) else np.int64)
    ends = ends[text.offset:text.offset + len(text) + 1].astype(np.int64)
    start = 0
    while start < len(text):
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(text))
        yield batch.slice(start, stop - start)
        start = stop


def plain_text(array: pa.Array) -> pa.Array:
    """The texts as a binary array with 64-bit offsets from 0; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    return pa.concat_arrays([array.cast(pa.large_string())]).cast(pa.large_binary())


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (starting at 0) and bytes of a large_binary array."""
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
    if data is None:
        return np.zeros(len(array) + 1, np.int64), np.zeros(0, np.uint8)
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]


def to_binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Cut texts before every blank or line feed that follows a character which
    is surely no white space.  Tokenizers that split at white space never join
    across such a cut, so equal chunks always give equal tokens.

    Returns the chunks and, per text, the number of chunks before it.
    """
    ends, data = raw(texts)
    if not len(data):
        return to_binary(np.zeros(1, np.int64), data), np.zeros(len(texts) + 1, np.int64)
    blank = (data == 32) | (data == 10)
    sure = (data > 32) & (data < 127)
    # two-byte characters that start with C3-DF hold no white space
    sure[1:] |= (data[1:] >= 128) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    cut = np.zeros(len(data), bool)
    cut[1:] = blank[1:] & sure[:-1]
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    at = np.flatnonzero(cut)
    before = np.searchsorted(at, ends)
    return to_binary(np.append(at, len(data)), data), before
