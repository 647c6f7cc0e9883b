"""Phrase collocations against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rill.llm import phrases


def brute(rows, least=30, most=2000):
    f, n = defaultdict(Counter), Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        scored = []
        for p, a in found.items():
            if 100 * inside[p] >= 80 * a:
                continue
            cuts = [(2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:most]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus():
    rows = [(None, None), ("en", None), ("en", ""), ("en", " \t.,;\n"), ("de", "Ärger ÄRGER"), (None, "a b " * 40)]
    rows += [("en", "Of the people, by THE people; for the people.\nof\tthe  people shall not")] * 25
    rows += [("en", "of the sea of the land of the sea! x y z w v u")] * 31 + [("fr", "x y z w v u " * 30)]
    rows += [("en", "une fois ; il était une fois")] * 15 + [("fr", "il était une fois, une fois")] * 15
    rows += [("es", "la la la la la la")] * 8 + [("es", "\x00a b c\x01")] * 33
    return rows


@pytest.mark.parametrize(("bits", "root", "hot", "step"), [(1 << 26, 512, 1024, 4 << 20), (64, 3, 60, 400)])
def test_against_brute_force(spark, bits, root, hot, step):
    """Also with a filter of many chance hits and with stripes in many parts."""
    docs = spark.createDataFrame([(*r, 1) for r in corpus()], "lang string, text string, phrase int").repartition(3)
    found = phrases.collocations(docs, filter_bits=bits, root_parts=root, hot=hot, step_bytes=step)
    assert sorted(map(tuple, phrases.best_of_each(found).collect())) == brute(corpus())


def test_few_of_each_and_lower_bound(spark):
    docs = spark.createDataFrame(corpus(), "lang string, text string")
    got = phrases.best_of_each(phrases.collocations(docs, least=8), most=3).collect()
    assert sorted(map(tuple, got)) == brute(corpus(), 8, 3)


def test_empty_table_and_rare_words(spark):
    docs = spark.createDataFrame([("en", "all words once")], "lang string, text string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.best_of_each(phrases.collocations(docs.limit(0))).count() == 0


def test_stripes_hold_the_totals_of_longer_prefixes(spark):
    """An extension's count is the sum of its own stripe, where its every
    occurrence is followed by a word."""
    docs = spark.createDataFrame([("en", "a b c a b d a b c x")] * 2, "lang string, text string")
    one = phrases.merged(phrases.counted(docs, 0), 1)
    two = phrases.merged(phrases.counted(docs, 1, phrases.frequent_bits(phrases.extensions(one))), 1)
    count = {r["phrase"]: r["a"] for r in phrases.extensions(one).collect()}
    total = {r["prefix"]: r["t"] for r in two.groupBy("prefix").agg(F.sum("total").alias("t")).collect()}
    assert count == {"a": 6, "b": 6, "c": 4, "d": 2, "x": 2} and total == {k: v for k, v in count.items() if k != "x"}
