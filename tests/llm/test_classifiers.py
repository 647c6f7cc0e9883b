"""Held-out accuracy, gradients and odd inputs of the two classifiers."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rill.llm import langid, quality_cnn, queries
from rill.llm.common import fold, table

ODD = [(1, None, None, None), (2, "", "en", "s"), (3, "123 !?", "de", "s"), (4, "ü", None, "s"),
       (None, "the and of the", "en", "s"), (5, "the thing and " * 9000, "en", "s"), (5, "the thing and", "en", "s")]


def odd_rows(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, score string")


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_language_held_out(spark):
    got = queries.op10_language_id(spark, SF_SMALL).collect()
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()}
    assert len(got) == len(lang)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    own = [r["lang_pred"] == lang[r["doc_id"]][0] for r in got if r["held_out"] and lang[r["doc_id"]][0]]
    assert len(own) > 50 and np.mean(own) > 0.95


def test_language_odd_inputs(spark):
    docs = odd_rows(spark)
    model = langid.train(docs, F.lit(True))
    got = langid.label(docs, model, prefix="x_").collect()
    assert [r["x_lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert all(r["x_lang_pred"] in ("en", "de", "und") for r in got) and len(got) == len(ODD)
    assert langid.train(docs, F.lit(False)) is None
    assert {r["lang_pred"] for r in langid.label(docs.drop("score"), None).collect()} == {"und"}
    empty = docs.limit(0).drop("score")
    assert langid.label(empty, model).count() == 0


def test_window_cuts_cover_every_byte():
    model = langid.Model(["a", "b"])
    texts = ["x" * n for n in (0, 1, 95, 96, 97, 500)]
    odds = model.score(pa.array(texts))
    assert np.allclose(odds.sum(1), [0, 1, 1, 1, 1, 1])
    alone = np.concatenate([model.score(pa.array([t])) for t in texts])
    assert np.allclose(odds, alone, atol=1e-6)


def test_backpropagation_through_time_matches_differences():
    rng = np.random.default_rng(3)
    layer = langid.Direction(rng)
    steps = rng.integers(97, 105, (7, 4))
    weight = rng.standard_normal((7, 4, langid.HIDDEN)).astype("f4")

    def loss():
        states = np.empty((7, 4, langid.HIDDEN), "f4")
        layer.run(steps, states, range(7), None)
        return float((states * weight).sum())

    kept = []
    layer.run(steps, np.empty((7, 4, langid.HIDDEN), "f4"), range(7), None, kept)
    d_table, d_back = layer.backward(steps, kept, weight)
    for w, g in ((layer.table, d_table), (layer.back, d_back)):
        for at in [np.unravel_index(k, g.shape) for k in np.argsort(-np.abs(g), axis=None)[:8]]:
            old, e = w[at], 2e-3
            w[at] = old + e
            up = loss()
            w[at] = old - e
            down = loss()
            w[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * e), rel=0.1, abs=0.02)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op3_quality_classifier(spark, sf).collect()
    label = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert all(r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == held_out(r["doc_id"]) for r in got)
    own = [r["predicted"] == label[r["doc_id"]] for r in got if r["held_out"] and r["doc_id"] in label]
    assert len(own) > 50 and np.mean(own) > 0.95


def test_quality_odd_inputs(spark):
    docs = odd_rows(spark).drop("score")
    labels = spark.createDataFrame([(5, 1), (5, 1), (2, 0), (None, 1), (9, 0), (3, None)], "doc_id long, quality int")
    model = quality_cnn.train(docs, labels, fold(F.col("doc_id")) >= 0)
    got = quality_cnn.score(docs, model, name="p").collect()
    assert len(got) == len(ODD) and all(0 <= r["p"] <= 1 for r in got)
    assert {r["p"] for r in got if r["doc_id"] in (1, 2)} == {got[0]["p"]}
    assert quality_cnn.train(docs, labels.limit(0), F.lit(True)) is None
    assert quality_cnn.score(docs.limit(0), model).count() == 0


def test_long_text_is_scored_whole():
    model = quality_cnn.Model()
    rng = np.random.default_rng(1)
    text = "".join(chr(c) for c in rng.integers(97, 123, 2 * quality_cnn.SPAN))
    halves, repeats, at = quality_cnn.half_chunks(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    whole = model.head(model.pool(model.inputs(halves, repeats), at)[0])[1]
    assert model.score(pa.array([text, "a"]))[0] == pytest.approx(whole[0], abs=1e-5)


def test_spans_give_the_scores_of_whole_texts(monkeypatch):
    """Naive convolution over all chunks of each text, against spans of 256 bytes."""
    monkeypatch.setattr(quality_cnn, "SPAN", 256)
    rng, half = np.random.default_rng(5), quality_cnn.HALF
    for seed in range(3):
        model = quality_cnn.Model(seed)
        texts = ["".join(chr(c) for c in rng.integers(97, 101, n)) for n in (0, 5, 200, 255, 256, 257, 300, 448, 449, 480, 1500)]
        want = []
        for t in texts:
            data = np.frombuffer(t.encode(), np.uint8)
            data = np.append(data, np.zeros(-len(data) % half, np.uint8))
            best = np.zeros(quality_cnn.FILTERS)
            halves = []
            for i in range(0, len(data), half):
                lags = [sum(data[k] == data[k - lag] for k in range(i, i + half) if k >= lag) / half for lag in quality_cnn.LAGS]
                halves.append(np.append(model.bytes[data[i:i + half]].reshape(-1), lags))
            for k, x in enumerate(halves):
                response = x @ model.filters[0]
                if k + 1 < len(halves):
                    response = response + halves[k + 1] @ model.filters[1]
                best = np.maximum(best, response)
            want.append(model.head(best[None].astype("f4"))[1][0])
        assert model.score(pa.array(texts)) == pytest.approx(np.array(want), abs=1e-5)


def sampled(monkeypatch, model_class):
    """Records what a model is fitted on."""
    seen = {}

    def fit(self, texts, labels, **_):
        seen["texts"], seen["labels"] = list(texts), list(labels)

    monkeypatch.setattr(model_class, "fit", fit)
    return seen


def hot_rows(spark):
    """One id on most rows, null ids, an empty language, one row repeated."""
    rows = [(7, f"row number {i} of the hot id", "en") for i in range(3000)]
    rows += [(None, f"row {i} without id", "en") for i in range(600)] + [(9, "always the same row", "de")] * 900
    rows += [(10 + i, f"another text {i}", "fr") for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)


def test_language_sample_is_bounded_by_language(spark, monkeypatch):
    seen = sampled(monkeypatch, langid.Model)
    model = langid.train(hot_rows(spark), F.lit(True), per_language=50)
    by = {name: seen["labels"].count(k) for k, name in enumerate(model.languages)}
    assert by == {"en": 50, "de": 1, "fr": 30}
    langid.train(hot_rows(spark), F.lit(True), per_language=50, max_rows=20)
    assert len(seen["texts"]) == 20 and len(set(seen["labels"])) == 3


def test_quality_sample_takes_one_text_per_id(spark, monkeypatch):
    seen = sampled(monkeypatch, quality_cnn.Model)
    labels = spark.createDataFrame([(7, 1), (7, 1), (9, 0), (10, 0), (11, 1), (None, 1)], "doc_id long, quality int")
    quality_cnn.train(hot_rows(spark), labels, F.lit(True))
    assert len(seen["texts"]) == 5 and sum(seen["labels"]) == 3 and len(set(seen["texts"])) == 4
    quality_cnn.train(hot_rows(spark), labels, F.lit(True), max_labels=2)
    assert len(seen["texts"]) == 2


def test_clashing_columns(spark):
    names = ["doc_id", "text", "lang", "__text", "__lang_pred", "__score", "doc", "h", "order", "id"]
    docs = spark.createDataFrame([(i, f"the thing and {i}", "ende"[2 * (i % 2):][:2]) + ("x",) * 7 for i in range(40)],
                                 f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names[2:])}")
    model = langid.train(docs, F.lit(True))
    got = langid.label(docs, model, prefix="__")
    assert all(0 <= r["__score"] <= 1 for r in got.collect())
    assert sorted(got.columns) == sorted(names) and {r["__lang_pred"] for r in got.collect()} <= {"en", "de"}
    assert langid.label(docs, model).columns == [*names, "lang_pred", "score"]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    scored = quality_cnn.score(docs, quality_cnn.train(docs, labels, F.lit(True)), name="__score")
    assert sorted(scored.columns) == sorted(names) and all(0 <= r["__score"] <= 1 for r in scored.collect())


def test_scores_do_not_depend_on_the_texts_before():
    model, rng = quality_cnn.Model(2), np.random.default_rng(9)
    texts = ["".join(chr(c) for c in rng.integers(97, 99, n)) for n in rng.integers(0, 60, 80)]
    alone = np.concatenate([model.score(pa.array([t])) for t in texts])
    assert model.score(pa.array(texts)) == pytest.approx(alone, abs=1e-6)
