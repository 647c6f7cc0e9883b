"""User code in the map/reduce style (X1-X3), run as Arrow-batched pandas
functions inside Spark tasks.

``map_combine`` runs a per-batch mapper and combines its output by key
inside the task before the shuffle (the combiner); ``reduce_groups`` runs a
reducer per key group.  Built-in aggregates remain the fast path; these
exist for logic that columns cannot express.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Characters of text given to a mapper at once.
STEP_CHARS = 1 << 20


def steps(pdf: pd.DataFrame, limit: int = STEP_CHARS) -> Iterator[pd.DataFrame]:
    """Slices of a batch with about ``limit`` characters of text (a longer row is
    a slice of its own); at most ``limit`` rows."""
    size = sum((pdf[c].map(lambda v: len(v) if isinstance(v, (str, bytes)) else 1).to_numpy("int64")
                for c in pdf.columns if pdf[c].dtype == object), np.ones(len(pdf), np.int64))
    ends, start = np.cumsum(size), 0
    while start < len(pdf):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield pdf.iloc[start:stop]
        start = stop


def map_combine(df: DataFrame, mapper: Callable[[pd.DataFrame], pd.DataFrame],
                schema: str, key: str, value: str) -> DataFrame:
    """Apply ``mapper`` to each step of an Arrow batch, sum ``value`` per
    ``key`` within the step, then finish the sum per key with a shuffle (partial
    sums of the task before it).  A mapper makes many objects of a text, so steps
    of bounded text bound a worker's memory."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for step in steps(pdf):
                out = mapper(step)
                if len(out):
                    yield out.groupby(key, as_index=False, sort=False)[value].sum()

    return df.mapInPandas(run, schema).groupBy(key).agg(F.sum(value).alias(value))


def reduce_groups(df: DataFrame, key: str, reducer: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """Run ``reducer`` on all rows of each key (one group per call).
    Use only on pre-combined input, where every group is small."""
    return df.groupBy(key).applyInPandas(reducer, schema)


def tokenize_counts(pdf: pd.DataFrame, text: str = "text") -> pd.DataFrame:
    """A mapper: whitespace tokens of the text column with count 1."""
    words = pdf[text].fillna("").str.split(r"[\t\n\x0b\f\r ]+", regex=True).explode()
    words = words[words.notna() & (words != "")]
    return pd.DataFrame({"word": words.astype(str).to_numpy(), "cnt": 1})
