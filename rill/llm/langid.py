"""Language identification by a bidirectional gated recurrent network over bytes.

Training (numpy, backpropagation through time) uses a bounded sample: at most
``per_language`` different rows of each language and ``max_rows`` in all, chosen
by a hash of id and text from the allowed folds, and of each at most ``stretch``
characters from a place chosen by another hash.
Each byte is one step, and at every position the two states together give the
log-odds of the languages; the loss is the cross entropy at every position.

Scoring covers every byte of every text: texts are cut into windows of
``WINDOW`` bytes that run side by side (states start afresh in each), every
position is labelled with probabilities, and their mean over the text is the
document's distribution.  Work runs in Arrow batches inside tasks; only the
weights (a few ten thousand numbers) are sent to them.

Defined cases: ``und`` with score 0 for a null text and for one without a
letter, and for all texts if there is nothing to learn from; null languages and
null texts are not learned from, of repeated rows one is; equal texts get equal
results; ties go to the language that sorts first; null ids stay null; the
input's columns travel in a struct, so their names cannot clash (one named like
a result gives way to it); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rill.llm.common import LOWER, plain_text, raw, text_steps
from rill.session import cut_lineage

HIDDEN, WINDOW, SIDE_BY_SIDE, STRETCH = 12, 96, 2048, 960
#: Longest gradient of a training step.
LARGEST = 5.0


class Direction:
    """One gated recurrent layer: update and reset gate (clipped linear) and
    candidate state, from a table row per byte and a recurrent matrix."""

    def __init__(self, rng: np.random.Generator):
        self.table = rng.standard_normal((256, 3 * HIDDEN)).astype("f4") * 0.2
        self.table[:, :2 * HIDDEN] += 0.5
        self.back = rng.standard_normal((HIDDEN, 3 * HIDDEN)).astype("f4") * 0.2

    def run(self, steps: np.ndarray, states: np.ndarray, order: range, live: np.ndarray | None,
            keep: list | None = None) -> None:
        """Fill ``states`` (time, window, unit); ``live`` marks bytes that are
        no padding; ``keep`` gets what backpropagation needs."""
        k = 2 * HIDDEN
        h = np.zeros(states.shape[1:], "f4")
        x, g = np.empty((len(h), 3 * HIDDEN), "f4"), np.empty((len(h), 3 * HIDDEN), "f4")
        for t in order:
            if keep is not None:
                x, g = np.empty_like(x), np.empty_like(g)
            np.take(self.table, steps[t], axis=0, out=x)
            np.matmul(h, self.back, out=g)
            gates = x[:, :k]
            gates += g[:, :k]
            free = (gates > 0) & (gates < 1) if keep is not None else None
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            n = g[:, k:] * gates[:, HIDDEN:]
            n += x[:, k:]
            np.tanh(n, out=n)
            new = states[t]
            np.subtract(h, n, out=new)
            new *= gates[:, :HIDDEN]
            new += n
            if live is not None:
                new *= live[t][:, None]
            if keep is not None:
                keep.append((t, h, gates, g[:, k:], n, free))
            h = new

    def backward(self, steps: np.ndarray, kept: list, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and matrix, given those of the states."""
        d = np.zeros(outer.shape[1:], "f4")
        inner = np.empty((*outer.shape[:2], 3 * HIDDEN), "f4")
        d_back = np.zeros_like(self.back)
        for t, h, gates, u, n, free in reversed(kept):
            d = d + outer[t]
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            dn = d * (1 - z) * (1 - n * n)
            dg = np.concatenate([d * (h - n) * free[:, :HIDDEN], dn * u * free[:, HIDDEN:], dn * r], 1)
            inner[t, :, :2 * HIDDEN], inner[t, :, 2 * HIDDEN:] = dg[:, :2 * HIDDEN], dn
            d_back += h.T @ dg
            d = d * z + dg @ self.back.T
        flat, by = inner.reshape(-1, 3 * HIDDEN), steps.reshape(-1)
        d_table = np.stack([np.bincount(by, flat[:, c], 256) for c in range(3 * HIDDEN)], 1).astype("f4")
        return d_table, d_back


class Model:
    def __init__(self, languages: list[str], seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forth, self.fro = Direction(rng), Direction(rng)
        self.out = np.zeros((2 * HIDDEN, len(languages)), "f4")
        self.bias = np.zeros(len(languages), "f4")

    def states(self, windows: np.ndarray, live: np.ndarray | None, keep=(None, None)) -> np.ndarray:
        """Both directions' states for (time, window) bytes."""
        both = np.empty((2, *windows.shape, HIDDEN), "f4")
        time = range(len(windows))
        self.forth.run(windows, both[0], time, live, keep[0])
        self.fro.run(windows, both[1], time[::-1], live, keep[1])
        return both

    def odds(self, both: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at every position."""
        logits = both[0] @ self.out[:HIDDEN]
        logits += both[1] @ self.out[HIDDEN:]
        logits += self.bias
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def fit(self, texts: list[bytes], labels: list[int], steps: int = 220, batch: int = 192, rate: float = 0.02,
            seed: int = 1) -> None:
        """Adam on random windows, as many of each language."""
        rng = np.random.default_rng(seed)
        data = [LOWER[np.frombuffer(t, np.uint8)] for t in texts]
        by = [[i for i, y in enumerate(labels) if y == c] for c in range(len(self.languages))]
        weights = [self.forth.table, self.forth.back, self.fro.table, self.fro.back, self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            y = np.arange(batch) % len(by)
            windows, live = np.zeros((WINDOW, batch), np.intp), np.zeros((WINDOW, batch), "f4")
            for b, c in enumerate(y):
                t = data[by[c][rng.integers(len(by[c]))]]
                at = rng.integers(max(1, len(t) - WINDOW // 2))
                got = t[at:at + WINDOW]
                windows[:len(got), b], live[:len(got), b] = got, 1
            kept: tuple[list, list] = ([], [])
            both = self.states(windows, live, kept)
            wrong = self.odds(both)
            wrong[:, np.arange(batch), y] -= 1
            wrong *= live[:, :, None] / live.sum()
            flat = wrong.reshape(-1, len(by))
            grads = []
            for k, (layer, kp) in enumerate(zip((self.forth, self.fro), kept, strict=True)):
                outer = wrong @ self.out[k * HIDDEN:(k + 1) * HIDDEN].T
                grads += layer.backward(windows, kp, outer)
            grads.append(np.concatenate([b.reshape(-1, HIDDEN).T @ flat for b in both]))
            grads.append(flat.sum(0))
            norm = np.sqrt(sum(float(np.square(g, dtype="f8").sum()) for g in grads))
            if not np.isfinite(norm):           # a few equal texts can drive the states out of bounds
                continue
            grads = [g * np.float32(min(1, LARGEST / max(norm, 1e-12))) for g in grads]
            speed = rate * min(1, 2 * (1 - step / (steps + 1)))
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= speed * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Mean probabilities of each text (rows of empty texts are zero)."""
        ends, data = raw(plain_text(texts))
        data = LOWER[data]
        length = np.diff(ends)
        count = -(-length // WINDOW)
        owner = np.repeat(np.arange(len(length)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        first = ends[owner] + nth * WINDOW
        size = np.minimum(length[owner] - nth * WINDOW, WINDOW)
        total = np.zeros((len(length), len(self.languages)))
        span = np.arange(WINDOW)[:, None]
        for whole in (True, False):
            chosen = np.flatnonzero((size == WINDOW) == whole)
            if not whole:                       # windows of like length together
                chosen = chosen[np.argsort(size[chosen], kind="stable")]
            for i in range(0, len(chosen), SIDE_BY_SIDE):
                w = chosen[i:i + SIDE_BY_SIDE]
                steps = span if whole else span[:size[w].max()]
                live = None if whole else (steps < size[w]).astype("f4")
                windows = data[np.minimum(first[w] + steps, len(data) - 1)].astype(np.intp)
                odds = self.odds(self.states(windows, live))
                if live is not None:
                    odds *= live[:, :, None]
                np.add.at(total, owner[w], odds.sum(0, dtype="f8"))
        return total / np.maximum(length, 1)[:, None]


def train(docs: DataFrame, allowed: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = 400, max_rows: int = 50_000, stretch: int = STRETCH, seed: int = 1) -> Model | None:
    """A model from a sample of the allowed rows (None without any)."""
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    rows = docs.filter(allowed & lang.isNotNull() & text.rlike(r"\p{L}"))
    key = lambda n: F.xxhash64(F.col(id_col).cast("string"), text, F.lit(seed + n))
    rows = rows.select(lang.alias("lang"), key(0).alias("order"), F.pmod(key(1), F.lit(1000)).alias("at"), text.alias("text"))
    # a share of each language's different rows, somewhat more than are used
    # (stored, so that Spark knows its size and broadcasts it if it is small)
    share = rows.groupBy("lang").agg((1.5 * per_language / F.approx_count_distinct("order", 0.02)).alias("share"))
    share = cut_lineage(share)
    draw = F.pmod("order", F.lit(1 << 30)) / float(1 << 30)
    at = F.floor(F.col("at") / 1000 * F.greatest(F.length("text") - stretch, F.lit(0))).cast("int") + 1
    sample = rows.join(share, "lang").filter(draw < F.col("share")).select(
        "lang", "order", F.substring(F.col("text"), at, F.lit(stretch)).alias("text"))
    sample = sample.groupBy("lang", "order").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    sample = sample.withColumn("nth", nth).filter(F.col("nth") <= per_language).orderBy("nth", "lang").limit(max_rows)
    got = sorted((r["lang"], r["order"], r["text"]) for r in sample.collect())
    languages = sorted({g[0] for g in got})
    if not languages:
        return None
    model = Model(languages, seed)
    model.fit([g[2].encode() for g in got], [languages.index(g[0]) for g in got])
    return model


def label(docs: DataFrame, model: Model | None, text_col: str = "text", carry: tuple[str, ...] = ("*",),
          prefix: str = "") -> DataFrame:
    """The columns in ``carry`` with lang_pred and score (names after ``prefix``)."""
    name, value = f"{prefix}lang_pred", f"{prefix}score"
    rows = judged(docs, model, text_col, carry)
    taken = (name.lower(), value.lower())
    kept = [F.col("doc")[c].alias(c) for c in rows.schema["doc"].dataType.names if c.lower() not in taken]
    return rows.select(*kept, F.col("lang_pred").alias(name), F.col("score").alias(value))


def judged(docs: DataFrame, model: Model | None, text_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """doc (a struct of the columns in ``carry``), lang_pred, score."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*carry).alias("doc"), F.when(text.rlike(r"\p{L}"), text).alias("text"))
    if model is None:
        return rows.select("doc", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            for step in text_steps(batch):
                odds = model.score(step.column("text"))
                best = np.where(odds.any(1), odds.argmax(1), len(model.languages))
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc"), pa.array(names[best], pa.string()),
                     pa.array(np.clip(odds.max(1, initial=0.0), 0, 1), pa.float64())],
                    ["doc", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc {kind}, lang_pred string, score double")
