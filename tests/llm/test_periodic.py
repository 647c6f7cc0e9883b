"""Periodic runs against a brute-force search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from rill.llm import periodic, queries
from rill.llm.common import table


def brute(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(periodic.LEAST, 2 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def row(doc_id, text):
    words = split(text)
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def odd_texts():
    rng = random.Random(7)
    texts = [None, "", " \n\t", "x", "é " * 11, "é " * 12, "a b\x0bc\x0cd\r\ne " * 9, "a b a b " * 8]
    for _ in range(250):
        letters = "abcdefgh"[:rng.choice([1, 2, 3, 8])]
        words = [rng.choice(letters) for _ in range(rng.choice([5, 12, 13, 40, 150]))]
        if len(words) > 20 and rng.random() < 0.6:
            at, p = rng.randrange(len(words) - 4), rng.randrange(1, 12)
            for i in range(at, min(len(words), at + rng.randrange(100))):
                words[i] = words[at + (i - at) % p]
        texts.append(rng.choice(["", "\n "]) + rng.choice([" ", "  ", "\n"]).join(words))
    return texts + texts[:40]


@pytest.mark.parametrize(("places", "step"), [(1 << 18, 2 << 20), (16, 300)])
def test_odd_texts(spark, places, step):
    rows = [(i if i % 9 else None, t, "own") for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = periodic.digest(periodic.find(docs, carry=("doc_id",), step_bytes=step, places=places)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == sorted((row(i, t) for i, t, _ in rows), key=str)


def test_columns_of_other_names_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 20, 5)], "runs long, text string, collapsed int")
    found = periodic.find(docs).first()
    assert found["doc"]["collapsed"] == 5 and found["collapsed"] == "a"
    assert [tuple(r) for r in found["runs"]] == [(0, 20, 1)]
    assert periodic.find(docs.limit(0)).count() == 0


def test_long_texts():
    """Long periods, a long text of one word, and copies of a long text."""
    rng = random.Random(3)
    base = [str(rng.randrange(40)) for _ in range(1500)]
    texts = [base + base + base[:700], ["x"] * 20_000, base, base, base[:31] * 3]
    number, _, _, at = periodic.words(pa.array([" ".join(t) for t in texts]))
    owner, start, end, q = periodic.text_runs(number, at)
    got = [[] for _ in texts]
    for t, s, e, p in zip(owner, start, end, q, strict=True):
        got[t].append((s, e - s, p))
    assert (0, 3700, 1500) in got[0] and got[1] == [(0, 20_000, 1)] and got[2] == got[3]
    assert got[4] == brute(texts[4]) and got[2] == brute(base)


def test_cover_and_extensions():
    assert all((periodic.SHIFT[i, j] + k) % 31 in periodic.COVER for i in range(31) for j in range(31) for k in (i, j))
    rng = np.random.default_rng(4)
    x = np.append(np.tile(rng.integers(0, 2, 90), 6), 9)
    ext = periodic.Extensions(x)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(0, len(x), 3), np.arange(0, len(x), 7)))
    i, j = i[i != j], j[i != j]

    def naive(a, b):
        k = 0
        while max(a, b) + k < len(x) and x[a + k] == x[b + k]:
            k += 1
        return k
    assert list(ext(i, j)) == [naive(a, b) for a, b in zip(i, j, strict=True)]


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want = []
    for r in docs:
        h, words = zlib.crc32(str(r["doc_id"]).encode()), split(r["text"])
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        # long texts: the brute force only where a word is repeated at all
        want.append(row(r["doc_id"], " ".join(words)) if len(words) < 3000 else None)
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF_SMALL).select(*COLUMNS).collect()}
    assert len(got) == len(docs)
    assert all(got[w[0]] == w for w in want if w) and sum(w is not None for w in want) > 150
