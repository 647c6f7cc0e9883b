"""Base spans against plain patterns; further spans beside other numbers."""

import functools
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rill.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_sum(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))
                    or kind == "card" and not (14 <= len(digits) <= 19 and check_sum(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(out)


def card(rng):
    digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(digits + c for c in "0123456789" if check_sum(digits + c))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé🎉") for _ in range(5))
    ip = lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4))
    phone = lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04}"
    mail = lambda: f"{word()[:2]}ab.{rng.randint(1, 99)}@mail1.example.com"
    out = {i: t for i, t in enumerate([
        None, "", "a@b.c@d.e.f x@y.com_foo@bar.com", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0004 9.9.9", "5 5-5",
        "9" * 20_000, "+1" + " " * 9000 + "2", "x" * 30_000 + "@", "+" * 50 + "1234567890", "1-" * 5000,
        "é🎉 a@b.co 🎉 +49 30 1234567", "4111 1111 1111 1111", "4111-1111-1111-1112", "(988) 555-2485",
        "hash 0641917ea4e9feb9cda83477b57ac2654884f485 key=4111111111111112a", "bob (at) mail (dot) org"])}
    letters = "0123456789 .-+()@ab%"
    out |= {100 + i: "".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for i in range(300)}
    for i in range(400):
        kinds = [rng.choice([ip, phone, mail, lambda: card(rng)])() for _ in range(2)]
        out[1000 + i] = f"{word()} {kinds[0]} {word()} {word()} {kinds[1]}, {word()}"
    out[2000] = f"{word()} +1 (269) 555-3296 4111111111111111 and"
    out[2001] = f"{word()} 4111111111111111 27.65.93.188 {word()}"
    out[2002] = "The GNU General Public License, version 3.0.1 of 2007"
    return out


def test_spans(spark, texts):
    rows = [(i, t, "x") for i, t in texts.items()] + [(3, texts[3], "x"), (None, texts[2000], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string").repartition(4)
    got = pii.digest(docs).collect()
    assert len(got) == len(rows)
    spans = {}
    for r in got:
        text = texts[2000 if r["doc_id"] is None else r["doc_id"]]
        want = brute(text)
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (r["doc_id"], text[:80], want, r["spans"])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[1] == i for w in want) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
        spans[r["doc_id"]] = r["spans"]
    of = lambda i: {(t.split(":")[0], texts[i][int(t.split(":")[1]):int(t.split(":")[2])])
                    for t in spans[i].split(",") if t}
    assert of(2000) == {("phone", "+1 (269) 555-3296"), ("card", "4111111111111111")}
    assert of(2001) == {("ip", "27.65.93.188"), ("card", "4111111111111111")}
    assert not of(2002) and not of(14)
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[2000] == texts[2000].replace("+1 (269) 555-3296", "[PHONE]").replace("4111111111111111", "[CARD]")
    assert clean[0] is None and clean[2002] == texts[2002]


def test_empty_table_and_no_candidates(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digest(docs).count() == 0
    assert pii.redact(spark.createDataFrame([(1, "a b")], docs.schema)).collect()[0]["text"] == "a b"


def test_trees_as_arrays_score_like_trees(spark):
    rng = random.Random(9)
    top = {"kind": 4, "digits": 24, "groups": 8, "marks": 15, "before": 3, "after": 3, "luhn": 3}
    draw = lambda: {f: rng.randint(0, top[f]) for f in pii.FEATURES}
    trees = [pii.grow([(draw(), rng.uniform(-1, 1), rng.random()) for _ in range(n)], pii.DEPTH) for n in (0, 1, 2, 5, 40, 200)]
    rows = [draw() for _ in range(50)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{f} int" for f in rows[0]))
    got = df.select(F.struct("*").alias("x")).select(pii.score(trees, F.col("x")).alias("s")).collect()
    assert [g.s for g in got] == [functools.reduce(lambda a, t: a + t.predict(r), trees, 0.0) for r in rows]  # noqa: B023


def test_expressions_stay_small(spark):
    """Executors compile these; large ones took gigabytes of their memory."""
    trees = [pii.grow([({f: (i * 7 + k) % 5 for k, f in enumerate(pii.FEATURES)}, (-1.0) ** i, 1.0) for i in range(40)], pii.DEPTH)] * pii.ROUNDS
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    nodes = lambda df: str(df._jdf.queryExecution().analyzed()).count("lambda ")
    assert nodes(pii.candidates(docs)) < 250
    x = F.struct(*(F.lit(1).alias(f) for f in pii.FEATURES)).alias("x")
    assert nodes(docs.select(x).select(pii.score(trees, F.col("x")))) < 20
