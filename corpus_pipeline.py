"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
it kept; all but the last return the columns of ``documents``.  ``run`` writes
each stage's result as Parquet under the folder in ``spark.checkpoint.dir`` and
reads it again, so that a lost executor costs no more than the stage under way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.llm import langid, neardup, packing, pii, quality_rules
from rill.llm.common import fold, table, vocabulary_file
from rill.session import cut_lineage

#: Least pooled probability of the predicted language, as a share of the way from
#: an even guess among the languages (0) to certainty (1).
LEAST_CERTAINTY = 0.1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive limits."""
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is recognised with some certainty;
    without labels to learn from, all documents with letters."""
    model = langid.train(docs, fold(F.col("doc_id")) != 1)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    even = 1 / len(model.languages)
    sure = F.col("score") >= even + LEAST_CERTAINTY * (1 - even)
    named = langid.judged(docs, model).filter((F.col("lang_pred") != "und") & (sure | F.lit(len(model.languages) == 1)))
    return named.select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the least id."""
    return neardup.one_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return packing.pack(docs, vocabulary_file("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("language ID", language), ("MinHash near-dedup", near_duplicates),
          ("PII", personal_data), ("best-fit packing", pack)]

#: Sketches, trained networks and hashed candidates have no SQL equivalent; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
