"""Counts against brute force; the limits adapt to language and source."""

import random
import re
from collections import Counter

import pytest

from rill.llm import quality_rules

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    words = re.findall(SPACE, text or "")
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"w{i}é" for i in range(400)]
    clean = lambda n: " ".join(rng.choice(words) for _ in range(n))
    odd = [None, "", "\n \t\n", "a b c a b c", "x\n\x0bx\n x\nx", "# $ %& |<>*" * 9, "a " * 3000, "é🎉 " * 70,
           " ".join("abc"[i % 3] for i in range(99)), "q" * 50_000, clean(20_000)]
    out = [(i, t, "en", "s0", 1) for i, t in enumerate(odd)]
    for k in range(1200):
        lang, source = rng.choice([("en", "s0"), ("en", "s1"), (None, "s0"), ("de", None)])
        # in s1 a third of all words carry a symbol: usual there, odd elsewhere
        text = clean(80)
        if source == "s1":
            text = " ".join(w + "#" * (rng.random() < 0.33) for w in text.split())
        out.append((100 + k, text, lang, source, 1))
    marked = " ".join(w + "#" * (i % 3 == 0) for i, w in enumerate(clean(90).split()))
    out += [(2000, marked, "en", "s1", 1), (2001, marked, "en", "s0", 1), (2001, marked, "en", "s0", 1),
            (2002, clean(90).upper().replace("W", "WXYZ"), "en", "s0", 1), (None, clean(90), "en", "s0", 1)]
    return out


def test_counts_and_verdicts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int").repartition(4)
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    kept = {}
    for r in got:
        own = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert own == brute(texts[r["doc"]["doc_id"]]), r["doc"]["doc_id"]
        assert not (r["kept"] and r["base_failed"])
        kept.setdefault(r["doc"]["doc_id"], set()).add(r["kept"])
    assert kept[2000] == {True} and kept[2001] == {False} and kept[2002] == {False} and kept[None] == {True}
    assert all(kept[i] == {True} for i in range(100, 1300))
    stay = quality_rules.keep(docs)
    assert stay.columns == docs.columns and stay.count() == sum(r["kept"] for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_rules.judge(docs).count() == 0


def test_limits_against_exact_quantiles(spark):
    """Limits from sorted values, within the sketches' rank error; nothing jumps at a size."""
    rng = random.Random(4)
    rows = []
    for source, n in (("tiny", 3), ("small", 199), ("more", 201), ("large", 3000)):
        for _ in range(n):
            rows.append((rng.choice(["en", "de"]), source, False, *(rng.random() ** 3 for _ in range(4)), rng.gauss(5, 1)))
    names = list(quality_rules.MARGIN)
    measured = spark.createDataFrame(rows, "lang string, source string, base_failed boolean, "
                                     + ", ".join(f"{m} double" for m in names)).repartition(5)
    got = {(r["g_lang"], r["g_source"]): r for r in quality_rules.limits(measured).collect()}
    assert set(got) == {r[:2] for r in rows}

    def own(some, m, side, shift):
        values = sorted(r[3 + names.index(m)] for r in some)
        at = lambda p: values[min(max(int((p + shift) * len(values)), 0), len(values) - 1)]
        low, mid, high, tail = at(0.25), at(0.5), at(0.75), at(0.99 if side > 0 else 0.01)
        margin = quality_rules.MARGIN[m]
        return mid + side * max(margin, min(8 * (high - low), side * (tail - mid) + margin / 2))

    for (lang, source), r in got.items():
        groups = [[x for x in rows if x[:2] == (lang, source)], [x for x in rows if x[0] == lang], rows]
        share = [len(g) / (len(g) + quality_rules.HALF_WEIGHT) for g in groups]
        for m in names:
            for side in (1, -1) if m in quality_rules.LOWER else (1,):
                least, most = [], []
                for g in groups:
                    around = [own(g, m, side, s) for s in (-0.005 - 1 / len(g), -0.005, 0, 0.005)]
                    least.append(min(around))
                    most.append(max(around))
                mix = lambda v: share[0] * v[0] + (1 - share[0]) * (share[1] * v[1] + (1 - share[1]) * v[2])
                value = r[f"max_{m}" if side > 0 else f"min_{m}"]
                assert mix(least) - 0.02 <= value <= mix(most) + 0.02, (lang, source, m)
                if side > 0 and m != "word_length":
                    assert value <= 1 + quality_rules.MARGIN[m] / 2


def test_words_of_one_letter_fall_below_the_lower_limit(spark):
    rng = random.Random(6)
    clean = lambda: " ".join(f"word{rng.randrange(500)}" for _ in range(80))
    docs = [(i, clean(), "en", "s") for i in range(300)]
    letters = [chr(c) for c in range(0x100, 0x200)]
    docs.append((999, " ".join(rng.choice(letters) for _ in range(90)), "en", "s"))
    got = quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"))
    assert {r["doc"]["doc_id"] for r in got.filter("not kept").collect()} == {999}
