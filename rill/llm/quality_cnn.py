"""Quality classifier: a byte-level convolutional network in numpy.

A text is read as overlapping chunks of 16 bytes, one every 8 bytes, from its
first byte to its last.  Learned filters see a chunk's byte embeddings and how
many of its bytes equal those 2 to 20 places before (repetition is invisible to
filters over single bytes).  Each filter's largest response over the whole text
(max pooling) goes into a small dense layer, which gives one probability.

Training (Adam, gradients by hand: through max pooling only the winning chunk
of each filter learns) uses a bounded sample of labelled documents: at most
``max_labels`` label rows, chosen by a hash of the id from the allowed folds,
one text per id, and of each text at most ``stretch`` characters from a place
chosen by the hash.  Scoring reads whole texts, in Arrow batches inside tasks.

Defined cases: a null text is empty; an empty text gets the score of a text
without chunks; without labels every score is 0.5; repeated labels all count;
null ids stay null and are never trained on; of several rows with a labelled id
one is trained on (the text with the least hash); equal texts get equal scores;
the input's columns travel in a struct, so their names cannot clash (one named
like the result gives way to it); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.llm.common import plain_text, raw, text_steps
from rill.session import cut_lineage

HALF, DIM, FILTERS, DENSE, STRETCH = 8, 6, 48, 16, 4000
LAGS = range(2, 21)
#: Bytes whose chunks are computed at once.
SPAN = 1 << 18


def half_chunks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into halves of 8 bytes, the last padded with zeros: bytes
    (half, 8), repetition counts (half, lag) and where each text's begin."""
    length = np.diff(ends)
    count = -(-length // HALF)
    at = np.append(0, np.cumsum(count))
    padded = np.zeros(at[-1] * HALF, np.uint8)
    if len(data):
        shift = np.repeat(at[:-1] * HALF - ends[:-1], length)
        padded[np.arange(len(data)) + shift] = data
    repeats = np.zeros((at[-1], len(LAGS)), "f4")
    ones = np.uint64(0x0101010101010101)
    begin = at[:-1][count > 0] * HALF
    for k, lag in enumerate(LAGS):
        same = np.zeros(len(padded), np.uint8)
        np.equal(padded[lag:], padded[:-lag], out=same[lag:].view(bool))
        # no byte equals one of the text before
        head = (begin[:, None] + np.arange(lag)).reshape(-1)
        same[head[head < len(same)]] = 0
        repeats[:, k] = (same.view(np.uint64) * ones >> np.uint64(56)).astype("f4")
    repeats *= 1 / HALF
    return padded.reshape(-1, HALF), repeats, at


class Model:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bytes = rng.standard_normal((256, DIM)).astype("f4") * 0.3
        wide = HALF * DIM + len(LAGS)
        # a filter's weights for the first and the second half of a chunk
        self.filters = rng.standard_normal((2, wide, FILTERS)).astype("f4") * (1 / np.sqrt(wide))
        self.dense = rng.standard_normal((FILTERS + 1, DENSE)).astype("f4") * 0.3
        self.out = rng.standard_normal(DENSE + 1).astype("f4") * 0.3

    def inputs(self, halves: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        return np.concatenate([self.bytes[halves].reshape(len(halves), HALF * DIM), repeats], 1)

    def pool(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter per text, at least 0, and where."""
        a, b = x @ self.filters[0], x @ self.filters[1]
        last = np.zeros(len(x), bool)
        last[at[1:][np.diff(at) > 0] - 1] = True
        a[:-1] += np.where(last[:-1, None], 0, b[1:])
        full = np.flatnonzero(np.diff(at) > 0)
        top = np.zeros((len(at) - 1, FILTERS), "f4")
        if len(full):
            top[full] = np.maximum(np.maximum.reduceat(a, at[full]), 0)
        return top, a

    def head(self, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(top @ self.dense[:-1] + self.dense[-1])
        return hidden, 1 / (1 + np.exp(-(hidden @ self.out[:-1] + self.out[-1])))

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 per text; long texts in spans of halves."""
        ends, data = raw(plain_text(texts))
        top = np.zeros((len(texts), FILTERS), "f4")
        first = 0
        while first < len(texts):
            stop = max(first + 1, int(np.searchsorted(ends, ends[first] + SPAN, side="right")) - 1)
            lo, hi = int(ends[first]), int(ends[stop])
            if hi - lo <= SPAN:
                halves, repeats, at = half_chunks(data[lo:hi], ends[first:stop + 1] - lo)
                top[first:stop] = self.pool(self.inputs(halves, repeats), at)[0]
            else:                               # one long text: overlapping spans
                for s in range(lo, hi, SPAN - 8 * HALF):
                    part = data[s:min(s + SPAN, hi)]
                    halves, repeats, at = half_chunks(part, np.array([0, len(part)]))
                    skip = 4 if s > lo else 0   # their lags reach before the span
                    x = self.inputs(halves, repeats)[skip:]
                    response = self.pool(x, np.array([0, len(x)]))[1]
                    # the last half's chunk goes on in the next span
                    response = response[:len(x) - (s + SPAN < hi)]
                    if len(response):
                        top[first] = np.maximum(top[first], response.max(0))
            first = stop
        return self.head(top)[1].astype("f8")

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 9, batch: int = 64, rate: float = 0.01,
            seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        made = [half_chunks(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[:2] for t in texts]
        weights = [self.bytes, self.filters, self.dense, self.out]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        share = np.clip(labels.mean(), 0.05, 0.95)
        step, steps = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for i in range(0, len(order), batch):
                step += 1
                chosen = order[i:i + batch]
                halves = np.concatenate([made[k][0] for k in chosen])
                at = np.append(0, np.cumsum([len(made[k][0]) for k in chosen]))
                x = self.inputs(halves, np.concatenate([made[k][1] for k in chosen]))
                top, response = self.pool(x, at)
                hidden, p = self.head(top)
                y = labels[chosen]
                # both labels weigh alike half way
                d = ((p - y) * np.where(y > 0, 0.5 + 0.25 / share, 0.5 + 0.25 / (1 - share)) / len(chosen)).astype("f4")
                d_out = np.append(hidden.T @ d, d.sum())
                dh = d[:, None] * self.out[:-1] * (1 - hidden * hidden)
                d_dense = np.vstack([top.T @ dh, dh.sum(0)])
                dt = dh @ self.dense[:-1].T
                d_bytes, d_filters = np.zeros_like(self.bytes), np.zeros_like(self.filters)
                for k in range(len(chosen)):
                    lo, hi = at[k], at[k + 1]
                    on = np.flatnonzero(top[k] > 0) if hi > lo else ()
                    if not len(on):
                        continue
                    win = lo + response[lo:hi, on].argmax(0)
                    for side in (0, 1):
                        use = win + side < hi
                        w, f = win[use] + side, on[use]
                        g = dt[k, f]
                        d_filters[side][:, f] += x[w].T * g
                        dx = (self.filters[side][:HALF * DIM, f] * g).T.reshape(-1, DIM)
                        np.add.at(d_bytes, halves[w].reshape(-1), dx)
                speed = rate * min(1, 2 * (1 - step / (steps + 1)))
                for w, g, m, v in zip(weights, (d_bytes, d_filters, d_dense, d_out), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= speed * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)


def order_of(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit(seed))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label_col: str = "quality", text_col: str = "text",
          id_col: str = "doc_id", max_labels: int = 2400, stretch: int = STRETCH, seed: int = 1) -> Model | None:
    """A model from a sample of the allowed label rows (None without any)."""
    order = order_of(id_col, seed)
    rows = labels.filter(allowed & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    chosen = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), order.alias("order"))
    # read twice below: at most ``max_labels`` rows of three numbers, which are broadcast
    chosen = cut_lineage(chosen.orderBy("order", "label").limit(max_labels))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    at = F.pmod(order_of("id", seed), F.lit(1000)) / 1000 * F.greatest(F.length("text") - stretch, F.lit(0))
    part = F.substring(F.col("text"), F.floor(at).cast("int") + 1, F.lit(stretch)).alias("text")
    # one text per id, combined before the shuffle: an id on many rows costs one row per task
    texts = texts.join(F.broadcast(chosen.select("id").distinct()), "id").select("id", F.xxhash64("text").alias("h"), part)
    texts = texts.groupBy("id").agg(F.min(F.struct("h", "text"))["text"].alias("text"))
    got = sorted((r["order"], r["label"], r["text"]) for r in texts.join(F.broadcast(chosen), "id").collect())
    if not got:
        return None
    model = Model(seed)
    model.fit([t.encode() for _, _, t in got], np.array([y for _, y, _ in got], "f4"))
    return model


def score(docs: DataFrame, model: Model | None, text_col: str = "text", carry: tuple[str, ...] = ("*",),
          name: str = "score") -> DataFrame:
    """The columns in ``carry`` with the probability of label 1."""
    rows = docs.select(F.struct(*carry).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType
    kept = [F.col("doc")[c].alias(c) for c in kind.names if c.lower() != name.lower()]
    if model is None:
        return rows.select(*kept, F.lit(0.5).alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in text_steps(batch):
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc"), pa.array(model.score(step.column("text")), pa.float64())], ["doc", "score"])

    scored = rows.mapInArrow(run, f"doc {kind.simpleString()}, score double")
    return scored.select(*kept, F.col("score").alias(name))
