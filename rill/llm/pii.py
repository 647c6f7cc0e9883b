"""Personal data by candidates and gradient-boosted trees, in DataFrame functions only.

1. *Generators* with high recall propose spans, which may overlap: the base
   formats (with what fails their checks), stricter shapes of cards and phones
   that base formats lose when other numbers stand next to them, addresses that
   are spelled out, long IP addresses.  Texts without a digit or an at-sign are
   passed by.  Positions follow from the lengths of the matches and of the
   texts between them, both split by the same pattern.
2. A candidate's *features* are small integers: kind, digits, digit groups,
   separators, Luhn sum, the characters around it.
3. *Trees* are boosted on counts of equal feature vectors over the whole corpus
   (bounded by the feature values, whatever the input).  Sure labels only:
   positive is what the base rules accept; negative is what they reject, what
   overlaps another accepted span, sticks to a letter or digit, or fails its
   check sum; the rest has no label.  The trees become one CASE expression.
4. *Thresholds* per kind are the lowest scores whose labelled candidates are
   personal in at least ``PRECISION`` of the cases.  Unlabelled candidates at
   or above them are added; of those that overlap, the best score stays, then
   the leftmost, then the longest.  Base spans always stay.

Defined cases: a null text is empty and has no spans; equal rows get equal
spans; null ids stay null; texts are searched whole; a corpus without positive
or negative candidates adds nothing; an empty table gives no rows; the input's
columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

# The base formats.  Leftmost matches, written so that a failed
# attempt is never repeated inside the same run of characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further generators: (kind, pattern).
MORE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
              r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9]{14,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){2,5}(?![0-9])"),
    ("phone", r"(?<![0-9+])\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
#: A text in which none of these stands has no candidate.
ANY = r"[0-9@]|[\[(]at[\])]"
FEATURES = ("kind", "digits", "groups", "marks", "before", "after", "luhn")
ROUNDS, DEPTH, RATE, PRECISION = 20, 3, 0.3, 0.99


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the check sum?"""
    turned = F.reverse(digits)

    def step(s: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return s + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def accepted(kind: Column, m: Column) -> Column:
    """Does a base match pass the check of its kind (a number from 1)?"""
    count = F.length(digits_of(m))
    part = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (
        F.when(F.length(F.regexp_replace(p, "^0+", "")) <= 3, F.regexp_replace(p, "^0+(?=.)", "").cast("int"))
        .otherwise(F.lit(999)) <= 255)
    return (F.when(kind == 3, F.when(count.between(14, 19), luhn(digits_of(m))).otherwise(F.lit(False)))
            .when(kind == 4, count.between(10, 15))
            .when(kind == 2, F.forall(F.split(m, r"\."), part))
            .otherwise(F.lit(True)))


def found(generator: Column) -> Column:
    """The spans of one generator (kind, base, matches and what is between
    them) with their features."""
    kind, matches, between = generator["kind"], generator["m"], generator["b"]
    around = lambda c: F.when(c.rlike(r"^[\p{L}_]"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\S"), 3).otherwise(0)

    def ends(s: Column, i: Column) -> Column:
        end = s["at"] + F.length(F.get(between, i)) + F.length(F.get(matches, i))
        return F.struct(end.alias("at"), F.array_append(s["all"], end).alias("all"))

    def span(end: Column, i: Column) -> Column:
        m = F.get(matches, i)
        digits = digits_of(m)
        count = F.length(digits)
        return F.struct(
            kind.alias("kind"), (end - F.length(m)).alias("s"), end.alias("e"),
            F.when(generator["base"], accepted(kind, m)).alias("base"),
            F.least(count, F.lit(24)).alias("digits"),
            F.least(F.size(F.split(m, "[^0-9]+")), F.lit(8)).alias("groups"),
            (m.rlike(r"\x20").cast("int") + 2 * m.rlike("-").cast("int") + 4 * m.rlike(r"[()]").cast("int")
             + 8 * m.rlike(r"\.").cast("int")).alias("marks"),
            around(F.right(F.get(between, i), F.lit(1))).alias("before"),
            around(F.left(F.get(between, i + 1), F.lit(1))).alias("after"),
            F.when(kind != 3, F.lit(3)).when(count.between(14, 19), luhn(digits).cast("int")).otherwise(F.lit(2)).alias("luhn"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.transform(F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), start, ends, lambda s: s["all"]), span)


def candidates(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """doc (a struct of the input's columns, or those in ``carry``), base
    (accepted spans) and other (all other candidates with features and label:
    1, 0 or null)."""
    rows = docs.select(F.struct(*carry).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("some", F.col("t").rlike(ANY))
    generators = [(k, p, True) for k, p in BASE.items()] + [(k, p, False) for k, p in MORE]
    none = F.array().cast("array<string>")
    rows = rows.select("doc", *(F.struct(
        F.lit(KINDS.index(k) + 1).alias("kind"), F.lit(base).alias("base"),
        F.when(F.col("some"), F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(none).alias("m"),
        F.when(F.col("some"), F.split("t", p, -1)).otherwise(none).alias("b")).alias(f"g{i}")
        for i, (k, p, base) in enumerate(generators)))
    # one expression for the spans of all generators: what Spark has to compile
    # and the virtual machine to inline does not grow with their number
    all_of = F.filter(F.array(*(f"g{i}" for i in range(len(generators)))), lambda g: F.size(g["m"]) > 0)
    rows = rows.select("doc", F.flatten(F.transform(all_of, found)).alias("c"))
    rows = rows.select("doc", F.filter("c", lambda x: x["base"]).alias("b"),
                       F.filter("c", lambda x: ~F.coalesce(x["base"], F.lit(False))).alias("c"))
    base = F.col("b")
    over = lambda x, y: (x["s"] < y["e"]) & (y["s"] < x["e"])
    sure_not = lambda x: (x["base"].isNotNull() | F.exists(base, lambda y: over(x, y)) | x["before"].isin(1, 2) | x["after"].isin(1, 2)
                          | x["luhn"].isin(0) | ((x["kind"] == 3) & (x["luhn"] == 2)))
    fields = ("kind", "s", "e", *FEATURES[1:])
    pick = lambda x, label: F.struct(*(x[f].alias(f) for f in fields), label.cast("int").alias("label"))
    same = lambda x: F.exists(base, lambda y: (x["kind"] == y["kind"]) & (x["s"] == y["s"]) & (x["e"] == y["e"]))
    return rows.select(
        "doc", F.transform(base, lambda x: pick(x, F.lit(1))).alias("base"),
        F.transform(F.filter("c", lambda x: ~same(x)),
                    lambda x: pick(x, F.when(sure_not(x), F.lit(0)))).alias("other"))


class Tree:
    """One regression tree: a leaf value, or a feature, a bound and two trees."""

    def __init__(self, value=0.0, feature=None, bound=None, low=None, high=None):
        self.value, self.feature, self.bound, self.low, self.high = value, feature, bound, low, high

    def predict(self, row: dict[str, int]) -> float:
        t = self
        while t.feature:
            t = t.low if row[t.feature] <= t.bound else t.high
        return t.value

    def laid_out(self, depth: int) -> tuple[list[tuple[int, int]], list[float]]:
        """The tree as a full one of this depth, level by level: (number of the
        feature, bound) of its inner nodes, and its leaves.  Below a leaf that
        stands higher up, all leaves have its value."""
        if not depth:
            return [], [float(self.value)]
        low, high = (t.laid_out(depth - 1) for t in ((self.low, self.high) if self.feature else (self, self)))
        nodes = [(FEATURES.index(self.feature), self.bound) if self.feature else (0, 0)]
        for level in range(depth - 1):
            here = slice((1 << level) - 1, (2 << level) - 1)
            nodes += low[0][here] + high[0][here]
        return nodes, low[1] + high[1]


def score(trees: list[Tree], x: Column) -> Column:
    """The trees' values for a candidate, added up in their order.

    The nodes are literal arrays that one short expression walks through: as an
    expression of its own for every node, the trees cost each executor gigabytes
    while they are compiled."""
    nodes, leaves = zip(*(t.laid_out(DEPTH) for t in trees), strict=True)
    of = lambda rows, kind: F.lit([v for r in rows for v in r]).cast(f"array<{kind}>")
    feature = of([[f for f, _ in n] for n in nodes], "int")
    bound = of([[b for _, b in n] for n in nodes], "int")
    leaf = of(leaves, "double")
    values = F.array(*(x[f].cast("int") for f in FEATURES))
    inner = (1 << DEPTH) - 1

    def down(at: Column, tree: Column) -> Column:
        node = tree * inner + at
        return at * 2 + F.when(F.get(values, F.get(feature, node)) <= F.get(bound, node), 1).otherwise(2)

    def add(total: Column, tree: Column) -> Column:
        at = F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.lit(0), lambda at, _: down(at, tree))
        return total + F.get(leaf, tree * (inner + 1) + at - inner)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(trees) - 1)), F.lit(0.0), add)


def grow(rows: list[tuple[dict[str, int], float, float]], depth: int) -> Tree:
    """A tree for (features, gradient, hessian) rows by second-order gain."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None, None)
    if depth:
        for f in FEATURES:
            by = defaultdict(lambda: [0.0, 0.0])
            for x, a, b in rows:
                by[x[f]][0] += a
                by[x[f]][1] += b
            lg = lh = 0.0
            for v in sorted(by)[:-1]:
                lg, lh = lg + by[v][0], lh + by[v][1]
                gain = lg ** 2 / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g ** 2 / (h + 1)
                if gain > best[0] + 1e-12:
                    best = (gain, f, v)
    if best[1] is None:
        return Tree(RATE * g / (h + 1))
    low, high = ([r for r in rows if (r[0][best[1]] <= best[2]) == side] for side in (True, False))
    return Tree(feature=best[1], bound=best[2], low=grow(low, depth - 1), high=grow(high, depth - 1))


def boost(counts: list[tuple[dict[str, int], int, int]]) -> tuple[list[Tree], dict[int, float]]:
    """Trees and thresholds by kind from (features, positives, negatives)."""
    trees, scores = [], [0.0] * len(counts)
    if not sum(p for _, p, _ in counts) or not sum(n for _, _, n in counts):
        return [], {}
    for _ in range(ROUNDS):
        rows = []
        for (x, p, n), s in zip(counts, scores, strict=True):
            q = 1 / (1 + math.exp(-s))
            rows.append((x, p * (1 - q) - n * q, (p + n) * q * (1 - q)))
        trees.append(grow(rows, DEPTH))
        scores = [s + trees[-1].predict(x) for (x, _, _), s in zip(counts, scores, strict=True)]
    limits = {}
    for kind in range(1, len(KINDS) + 1):
        right = wrong = 0
        for s, p, n in sorted(((s, p, n) for (x, p, n), s in zip(counts, scores, strict=True) if x["kind"] == kind),
                              key=lambda r: -r[0]):
            right, wrong = right + p, wrong + n
            if right >= PRECISION * (right + wrong) and s > 0:
                limits[kind] = s
    return trees, limits


def find(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """doc, base and spans: arrays of (s, kind, e), each in order of s, kind, e."""
    stored = cut_lineage(candidates(docs, text_col, carry))
    labelled = stored.select(F.explode(F.concat("base", "other")).alias("x")).filter("x.label is not null")
    counts = labelled.groupBy(*(F.col(f"x.{f}").alias(f) for f in FEATURES)).agg(
        F.sum("x.label").alias("p"), F.sum(1 - F.col("x.label")).alias("n"))
    # bounded by the values that features can take
    trees, limits = boost([({f: r[f] for f in FEATURES}, r["p"], r["n"])
                           for r in counts.orderBy(*FEATURES).collect()])
    place = lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"))
    plain = lambda a: F.array_sort(F.transform(a, place))
    if not limits:
        return stored.select("doc", plain(F.col("base")).alias("base"), plain(F.col("base")).alias("spans"))
    enough = lambda x: functools.reduce(
        lambda c, k: c.when(x["kind"] == k, F.lit(limits[k])), limits, F).otherwise(F.lit(math.inf))
    scored = F.transform(F.filter("other", lambda x: x["label"].isNull()), lambda x: F.struct(
        (-score(trees, x)).alias("minus"), x["s"].alias("s"), (-x["e"]).alias("me"), x["kind"].alias("kind"), x["e"].alias("e"),
        enough(x).alias("least")))
    ranked = F.array_sort(F.filter(scored, lambda x: -x["minus"] >= x["least"]))
    none = F.filter(F.transform(ranked, place), lambda x: F.lit(False))
    chosen = F.aggregate(ranked, none, lambda kept, x: F.when(
        F.exists(kept, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])), kept).otherwise(
        F.array_append(kept, place(x))))
    rows = stored.select("doc", plain(F.col("base")).alias("base"), chosen.alias("more"))
    return rows.select("doc", "base", F.array_sort(F.concat("base", "more")).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["s"], x["e"])), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, numbers of base spans by kind, base_sha256, spans."""
    rows = find(docs, text_col, (id_col,))
    of = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    counts = (of(k).alias(f"n_{name}") for k, name in enumerate(KINDS, 1))
    return rows.select(f"doc.{id_col}", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                       written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets (spans
    that overlap become one, named after the first); a null text stays null."""
    columns = docs.columns
    rows = find(docs, text_col)
    text = F.col(f"doc.{text_col}")
    tag = lambda k: F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), k)), F.lit("]"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda a, x: F.when(x["s"] < a["at"], F.struct(
        F.greatest(a["at"], x["e"]).alias("at"), a["parts"].alias("parts"))).otherwise(F.struct(
            x["e"].alias("at"), F.array_append(a["parts"], F.concat(
                F.substring(text, a["at"] + 1, x["s"] - a["at"]), tag(x["kind"]))).alias("parts")))
    done = F.aggregate(F.col("spans"), start, step, lambda a: F.concat(
        F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    clean = F.when(F.size("spans") == 0, text).otherwise(done)
    return rows.select(*(clean.alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in columns))
