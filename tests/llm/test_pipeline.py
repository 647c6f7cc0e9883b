"""The stages' decisions take effect, one after the other."""

import random

import corpus_pipeline
from conftest import SF_SMALL
from rill.llm.common import table
from test_near_duplicates import brute
from test_pii import brute as personal


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["the", "and", "onthe", "thing", "whin", "ofer", "ndher", "ea"])
                              + str(rng.choice(["", "s", "t", "re"])) for _ in range(n))
    base = text(200)
    more = [(10_000, base, "en", "s", 1), (10_001, base, "en", "s", 1), (10_002, base + " more", "en", "s", 1),
            (10_003, "the end", "en", "s", 1), (10_004, "7 8 9 " + " ".join(f"{i}" for i in range(400)), "en", "s", 1),
            (10_005, None, "en", "s", 1), (10_006, text(90) + " bob.1@mail.example.com " + text(90), "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_SMALL)
        assert docs.columns == before.columns
        docs = spark.createDataFrame(docs.collect(), before.schema)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not {10_003, 10_005} & set(kept["quality rules"]) and 10_002 in kept["quality rules"]
    assert 10_004 in kept["quality rules"] and 10_004 not in kept["language ID"]
    assert {10_000, 10_001, 10_002} & set(kept["MinHash near-dedup"]) == {10_000}
    rows = sorted(kept["language ID"].items())
    firsts = {i for (i, _), c in zip(rows, brute(rows), strict=True) if i == c}
    assert len(firsts ^ set(kept["MinHash near-dedup"])) <= 1
    assert set(kept["PII"]) == set(kept["MinHash near-dedup"])
    assert "[EMAIL]" in kept["PII"][10_006] and not any(personal(t) for t in kept["PII"].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in packed.collect()} == set(kept["PII"])


def test_run_and_empty_table(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 50
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0
