"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every text is measured once: words, symbols, repeated lines, words inside
repeated three-word windows, capital letters.  Two fixed base rules reject what
is too short or repeats itself.  All further limits come from the data: for
each language and source, mergeable KLL quantile sketches of each share are
built from the documents that pass the base rules (partial sketches per task,
merged after one small shuffle, so a source that holds a third of all rows is
no hot key).  An upper limit is the median plus a multiple of the quartile
distance, at most half a margin above the 99th percentile (so a wide spread does
not put it out of reach), at least a margin above the median; word length has a
lower limit by the same rule downwards.  Limits of a group of n documents weigh
n / (n + HALF_WEIGHT) against those of its language, and these against those of
everything, so that no limit jumps when a group grows.  The table of limits has
one row per language and source and is joined to the measures.

KLL sketches compact at random: a percentile's rank may be off by about 0.3 % of
the documents (k = 1024), so a document within that distance of a limit may be
judged differently by another run.

Repeated windows are found inside a row: 64-bit hashes of the windows are
packed with their positions, sorted as plain longs, and windows whose packed
hashes have an equal neighbour are compared by their whole hash.

Defined cases: a null text has no words (rejected as too short), null language
and null source are groups of their own, equal rows are judged alike, an empty
table gives no rows, texts are taken whole, and the input's columns travel in a
struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rill.session import cut_lineage

# White space between words, and the characters counted as symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Least distance of a limit from the median, by measure (upper and lower limits).
MARGIN = {"symbol_share": 0.05, "capital_share": 0.3, "dup_line_share": 0.4,
          "repeat_share": 0.3, "word_length": 3.5}
LOWER = ("word_length",)
#: Quartile distances between the median and the limit.
SPREAD = 8.0
#: Documents at which a group's own limits weigh as much as the wider ones.
HALF_WEIGHT = 40
SKETCH_K = 1024


def repeated_words(words: Column, windows: Column, mask: Column, docs: DataFrame) -> DataFrame:
    """Adds q_repeat: words that stand in a three-word window found twice."""
    same = lambda a, b: F.coalesce(a.bitwiseAND(F.bitwise_not(mask)) == b.bitwiseAND(F.bitwise_not(mask)), F.lit(False))
    docs = docs.withColumn("q_sorted", F.sort_array(F.transform(
        windows, lambda x, i: x.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))))
    packed = F.col("q_sorted")
    near = F.filter(packed, lambda x, i: same(x, F.get(packed, i - 1)) | same(x, F.get(packed, i + 1)))
    docs = docs.withColumn("q_near", F.sort_array(F.transform(
        near, lambda x: F.struct(F.get(windows, x.bitwiseAND(mask).cast("int")).alias("h"),
                                 x.bitwiseAND(mask).cast("int").alias("p")))))
    pairs = F.col("q_near")
    equal = lambda s, i: F.coalesce(s["h"] == F.get(pairs, i)["h"], F.lit(False))
    docs = docs.withColumn("q_at", F.sort_array(F.transform(
        F.filter(pairs, lambda s, i: equal(s, i - 1) | equal(s, i + 1)), lambda s: s["p"])))
    at = F.col("q_at")
    covered = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    return docs.withColumn("q_repeat", F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x))


def measure(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """doc (a struct of the input's columns, or those in ``carry``), lang, source, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, the five shares,
    base_failed."""
    rows = docs.select(F.struct(*carry).alias("doc"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("q_text"))
    text = F.col("q_text")
    rows = rows.withColumn("q_words", F.filter(F.split(text, SPACE), lambda x: x != ""))
    words = F.col("q_words")
    rows = rows.withColumn("q_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("n_words", F.size(words).cast("long"))
    hashes = F.transform(words, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    rows = rows.select(
        "doc", "lang", "source", "n_words",
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).alias("q_capitals"),
        F.size("q_lines").alias("q_n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("q_windows"),
        F.expr("shiftleft(1L, length(bin(n_words))) - 1").alias("q_mask"))
    rows = repeated_words(words, F.col("q_windows"), F.col("q_mask"), rows)
    chars, n = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("q_repeat") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select(
        "doc", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.col("q_repeat").alias("n_repeat_words"),
        (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("q_capitals") / chars).alias("capital_share"),
        (F.col("n_dup_lines") / F.greatest("q_n_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("q_repeat") / n).alias("repeat_share"), (F.col("word_chars") / n).alias("word_length"),
        failed.alias("base_failed"))


def limit(sketch: Column, margin: float, side: int) -> Column:
    """The upper (``side`` 1) or lower (-1) limit from one sketch."""
    tail = 0.99 if side > 0 else 0.01
    q = F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(p) for p in (0.25, 0.5, 0.75, tail))))
    spread = F.least(SPREAD * (q[2] - q[0]), side * (q[3] - q[1]) + margin / 2)
    return q[1] + side * F.greatest(F.lit(margin), spread)


def limits(measured: DataFrame) -> DataFrame:
    """One row per language and source: max_ and min_ limits of the measures."""
    groups = measured.filter(~F.col("base_failed")).groupBy("lang", "source").agg(
        F.count("*").alias("n"), *(F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MARGIN))
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in MARGIN)]
    wider = lambda *keys: groups.groupBy(*keys).agg(F.struct(*merged).alias("s"))
    one = (F.col("n") > 0).alias("one")
    own = groups.select("lang", "source", F.struct("n", *MARGIN).alias("own"), one)
    by_lang = wider("lang").select(F.col("lang").alias("l"), F.col("s").alias("by_lang"))
    whole = groups.select("*", one).groupBy("one").agg(F.struct(*merged).alias("whole"))
    table = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")), "left").join(whole, "one", "left")
    weight = lambda g: F.col(f"{g}.n") / (F.col(f"{g}.n") + HALF_WEIGHT)
    out = []
    for m, margin in MARGIN.items():
        for side in (1, -1) if m in LOWER else (1,):
            own_, lang_, whole_ = (limit(F.col(f"{g}.{m}"), margin, side) for g in ("own", "by_lang", "whole"))
            wide = weight("by_lang") * lang_ + (1 - weight("by_lang")) * whole_
            mixed = weight("own") * own_ + (1 - weight("own")) * wide
            out.append(mixed.alias(f"max_{m}" if side > 0 else f"min_{m}"))
    return table.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *out)


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", carry: tuple[str, ...] = ("*",)) -> DataFrame:
    """The measures of every document and ``kept``.

    The measures are stored once: limits and the final filter both read them.
    """
    measured = cut_lineage(measure(docs, text_col, lang_col, source_col, carry))
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    joined = measured.join(cut_lineage(limits(measured)), same, "left")
    fine = F.lit(True)
    for m in MARGIN:
        fine &= F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True))
    for m in LOWER:
        fine &= F.coalesce(F.col(m) >= F.col(f"min_{m}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & fine).drop("g_lang", "g_source")


def keep(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that pass, with the columns that they came with."""
    return judge(docs, **columns).filter("kept").select("doc.*")
