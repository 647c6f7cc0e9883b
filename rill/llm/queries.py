"""Registered queries of the numbered operators: thin calls with production parameters."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.llm import (bpe, chat, langid, neardup, nndescent, packing, periodic, phrases, pii, quality_cnn, quality_rules,
                      topk, warc)
from rill.llm.common import fold, table, vocabulary_file

QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text and the text decoded from them, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, the base rules and the verdict of the adaptive limits."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), carry=("doc_id",))
    return judged.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of personal data by number and digest, and all spans."""
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality probability of every text; fold 1 is held out of training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold(F.col("doc_id")) == 1
    model = quality_cnn.train(docs, labels, ~held)
    scored = quality_cnn.score(docs, model, carry=("doc_id",))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; fold 1 is held out of training."""
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id")) == 1
    named = langid.label(docs, langid.train(docs, ~held), carry=("doc_id",))
    return named.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates (its least doc_id) of every document."""
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc.doc_id", "class_id")


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that speaks in control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.format_turns(turns.union(hard)), in_order=True)


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, read back in order of the merged index."""
    return warc.archive(table(spark, sf_dir, "pages"))


@query
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of every vector whose id is divisible by 100."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLES["op5_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(x.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    index = nndescent.build(vectors, copies=6)
    queries = nndescent.valid(vectors, "vec_id", "embedding").filter(F.col("id") % 50 == 0)
    return nndescent.search(index, queries, 5, spent=True)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; texts whose id's crc32 h ends in 0 (a null id counts as
    empty text) repeat p of their words from word a on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", h.alias("h"), F.coalesce("text", F.lit("")).alias("text"))

    def tail(text: str, h: int) -> str:
        words, g = re.findall(r"[^\x20\x09-\x0D]+", text), h // 10
        n = len(words)
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, h = batch.column("text"), batch.column("h").to_numpy()
            use = np.flatnonzero(h % 10 == 0)
            new = [tail(t, int(x)) for t, x in zip(text.take(pa.array(use)).to_pylist(), h[use], strict=True)]
            text = pc.replace_with_mask(text, pa.array(h % 10 == 0), pa.array(new, text.type))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], ["doc_id", "text"])

    return rows.mapInArrow(run, docs.select("doc_id", "text").schema)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, a tenth of the texts given a periodic tail first."""
    docs = with_periodic_tails(table(spark, sf_dir, "documents"))
    return periodic.digest(periodic.find(docs, carry=("doc_id",)))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of each language."""
    return phrases.best_of_each(phrases.collocations(table(spark, sf_dir, "documents")))


ORACLES["op13_phrase_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (VALUES (1), (2), (3), (4)) AS s(k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL
), size AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30
), inner_part AS (
  SELECT c.lang, array_to_string(c.w[i.i:i.i + m.m - 1], ' ') AS phrase, max(c.a) AS most
  FROM c, (VALUES (2), (3)) AS m(m), (VALUES (1), (2), (3)) AS i(i)
  WHERE m.m < c.k AND i.i + m.m - 1 <= c.k GROUP BY ALL
), two AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.a, j.j, array_to_string(c.w[1:j.j], ' ') AS head, array_to_string(c.w[j.j + 1:], ' ') AS tail
  FROM c, (VALUES (1), (2), (3)) AS j(j) WHERE j.j < c.k
), cut AS (
  SELECT two.lang, two.phrase, two.a, j, x.a AS l, y.a AS r,
         CAST((2000000 * CAST(two.a AS HUGEINT)) // (x.a + y.a) AS BIGINT) AS score
  FROM two JOIN f x ON x.lang = two.lang AND x.phrase = two.head JOIN f y ON y.lang = two.lang AND y.phrase = two.tail
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_part i USING (lang, phrase) WHERE i.most IS NULL OR 100 * i.most < 80 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN size USING (lang)
QUALIFY rank <= 2000
"""
