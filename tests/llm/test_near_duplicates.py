"""Signatures against exact similarity; classes against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_MID
from rill.llm import bagminhash, neardup
from rill.llm.common import table


def bag(text):
    words = [w for w in (text or "").replace("\x0b", " ").split() if w]
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[k:] for k in range(5)), strict=False))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def brute(rows):
    """Least id of each row's class; rows are (id, text)."""
    bags = {t: bag(t) for _, t in rows}
    texts = [t for t in bags if bags[t]]
    where = defaultdict(list)
    for i, t in enumerate(texts):
        for s in bags[t]:
            where[s].append(i)
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, t in enumerate(texts):
        near = Counter(j for s in bags[t] for j in where[s] if j < i)
        for j in near:
            if find(i) != find(j) and jaccard(bags[t], bags[texts[j]]) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    number = {t: i for i, t in enumerate(texts)}
    for i, t in rows:
        if t in number and i is not None:
            c = find(number[t])
            least[c] = min(least.get(c, i), i)
    return [least[find(number[t])] if t in number else i for i, t in rows]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.random()}"
    return " ".join(out)


def planted():
    rng = random.Random(6)
    vocabulary = [f"w{i}é" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    odd = [None, "", " \n", "one", "one", "one two three four", "a b c d e", "a  b\nc d e", "q " * 4000, "q " * 4200,
           "q " * 9000, "same words " * 50, "same words " * 48]
    rows = list(enumerate(odd))
    base = text(150)
    rows += [(1000 + i, edited(rng, base, rng.randint(0, 12))) for i in range(250)]     # one hot, loose group
    rows += [(2000 + i, " ".join(base)) for i in range(200)]
    for g in range(60):
        own = text(rng.randint(8, 300))
        rows += [(3000 + 10 * g + i, edited(rng, own, i)) for i in range(4)]
    passage = text(40)
    rows += [(5000 + i, " ".join(passage + text(120))) for i in range(50)]              # a shared passage only
    rows += [(9007, "again the same id"), (9007, "again the same id")]
    return rows


def test_registers_agree_as_the_weighted_similarity():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(8)]
    left, right, exact = [], [], []
    for _ in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))] + ["r"] * rng.randint(0, 40)
        other = edited(rng, words, rng.randint(0, 10)).split() + ["r"] * rng.randint(0, 30)
        left.append(" ".join(words))
        right.append(" ".join(other))
        exact.append(jaccard(bag(left[-1]), bag(right[-1])))
    exact = np.array(exact)
    assert np.allclose(bagminhash.similarity(pa.array(left), pa.array(right)), exact)
    sigs = [bagminhash.signatures(*bagminhash.shingles(pa.array(t)), len(t)) for t in (left, right)]
    off = (sigs[0] == sigs[1]).mean(1) - exact
    assert abs(off.mean()) < 0.01 and (np.abs(off) < 0.25).all()
    # a text's signature does not depend on its batch
    alone = bagminhash.signatures(*bagminhash.shingles(pa.array(left[7:8])), 1)
    assert (alone[0] == sigs[0][7]).all()


def test_planted_classes(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows] + [(None, "one", 1)], "doc_id long, text string, class_id int")
    got = neardup.classes(docs.repartition(5)).collect()
    want = Counter(zip((i for i, _ in rows), brute(rows), strict=True))
    have = Counter((r["doc"]["doc_id"], r["class_id"]) for r in got)
    assert have.pop((None, 3)) == 1
    right = sum((want & have).values())
    assert len(got) == len(rows) + 1 and right >= 0.99 * len(rows)
    # no class joins what brute force keeps apart
    apart = dict(zip((i for i, _ in rows), brute(rows), strict=True))
    assert all(apart[r["class_id"]] == apart[r["doc"]["doc_id"]] for r in got if r["doc"]["doc_id"] is not None)


def loose(pairs):
    """A group of texts of similarity 0.78, each with one partner at 0.815."""
    rng = random.Random(7)
    common, rows = " ".join(f"c{i}" for i in range(124)), []
    for g in range(pairs):
        own = [" ".join(f"x{rng.random()}" for _ in range(n)) for n in (3, 14, 14)]
        rows += [(g, f"{common} {own[0]} {own[1]}"), (100_000 + g, f"{common} {own[0]} {own[2]}")]
    return rows


def test_pairs_of_a_loose_group(spark):
    rows = loose(400)                           # more than one part of a bucket
    assert 0.77 < jaccard(bag(rows[0][1]), bag(rows[2][1])) < 0.79 and jaccard(bag(rows[0][1]), bag(rows[1][1])) > 0.81
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc"]["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert [i for i in got if got[i] != i % 100_000] == []


def test_one_of_each_class_stays(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, row int")
    stay = neardup.one_each(docs)
    kept = Counter(r["doc_id"] for r in stay.collect())
    assert stay.columns == docs.columns
    firsts = Counter({i for (i, t), c in zip(rows, brute(rows), strict=True) if i == c} | {0, 1, 2})
    assert len(kept - firsts) + len(firsts - kept) <= 0.01 * len(rows)
    assert kept[9007] == 1 and kept[2000] == 0


def test_empty_table_and_no_links(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.classes(docs).count() == 0 and neardup.one_each(docs).count() == 0


def test_given_table(spark):
    docs = table(spark, SF_MID, "documents").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc"]["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    want = dict(zip((i for i, _ in rows), brute(rows), strict=True))
    assert sum(got[i] != want[i] for i in want) <= 0.002 * len(want)
