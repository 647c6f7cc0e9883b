"""BPE against the tokenizers library; packing against brute-force ids."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

from rill.llm import bpe, packing
from rill.llm.common import vocabulary_file

HARD = [None, "", " ", "  a   b\n\n c  \n", "<|endoftext|>x <|endoftext|> y", "don't we'll  'S  x",
        "  　日本語 テスト 🎉🎉🎉  ", "a" * 5000, "é" * 3000 + " " * 3000 + "b",
        "\t\t x\t y\r\n z", "\x85 a b \x1c\x1d x 12345 ²½", "<|endof<|endoftext|", "aaaa" * 99 + "\n \n"]


def hard_texts():
    rng = random.Random(3)
    letters = " \n\tabtheinTHE'sdl019.,! é日🎉 <|>"
    return HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    texts = hard_texts()
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(3, texts[3], 7), (None, "the end", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 int").repartition(3)


def test_every_token_encodes_to_itself():
    with open(vocabulary_file("byte_bpe_50k.json"), "rb") as f:
        tables = bpe.Bpe(f.read())
    words = [(i, t.decode()) for i, t in enumerate(tables.token)
             if t.decode("utf-8", "ignore").encode() == t and i not in tables.special.values()]
    assert len(words) > 40_000
    assert all(tables.word(w) == [i] for i, w in words)


def test_round_trip_equals_library(docs):
    lib = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    got = bpe.round_trip(docs, vocabulary_file("byte_bpe_50k.json")).collect()
    texts = dict(enumerate(hard_texts())) | {None: "the end"}
    assert len(got) == len(texts) + 1
    for r in got:
        ids = lib.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_encode_then_decode_gives_the_text(docs):
    path = vocabulary_file("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(docs, path), path).collect()
    texts = dict(enumerate(hard_texts())) | {None: "the end"}
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(empty, vocabulary_file("byte_bpe_50k.json")).count() == 0
    assert packing.pack(empty, vocabulary_file("word_bpe_49k.json")).count() == 0


def test_pieces_are_whole_and_sequences_gapless(docs):
    lib = Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))
    texts = dict(enumerate(hard_texts())) | {None: "the end"}
    for capacity in (2048, 16):
        got = packing.pack(docs, vocabulary_file("word_bpe_49k.json"), capacity).collect()
        bins, own = defaultdict(list), defaultdict(list)
        for r in got:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
            own[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        for spans in bins.values():
            end = 0
            for offset, length in sorted(spans):
                assert offset == end
                end += length
            assert end <= capacity
        for i, text in texts.items():
            ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
            want = [(n, s, len(ids[s:s + capacity]),
                     zlib.crc32(struct.pack(f"<{len(ids[s:s + capacity])}I", *ids[s:s + capacity])))
                    for n, s in enumerate(range(0, len(ids), capacity))]
            assert sorted(own[i]) == sorted(want * (2 if i == 3 else 1))
        total = sum(r["length"] for r in got)
        assert len(bins) <= -(-total // capacity) * 1.02 + 1


def test_fullest_equals_brute_force():
    from itertools import product
    rng = random.Random(5)
    for _ in range(200):
        left = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 60)
        best = max(s for n in product(*(range(c + 1) for c in left.values()))
                   if (s := sum(a * b for a, b in zip(n, left, strict=True))) <= room)
        got = packing.fullest(left, room)
        assert sum(k * n for k, n in got.items()) == best
        assert all(n <= left[k] for k, n in got.items())


def test_plan_is_close_to_the_least_number():
    rng = random.Random(7)
    counts = defaultdict(int)
    for _ in range(20_000):
        counts[min(2048, int(rng.lognormvariate(6, 1)) + 1)] += 1
    patterns = packing.plan(counts, 2048)
    used = defaultdict(int)
    for bin_, times in patterns:
        assert sum(k * n for k, n in bin_.items()) <= 2048
        for k, n in bin_.items():
            used[k] += n * times
    assert used == counts
    assert sum(t for _, t in patterns) <= -(-sum(k * n for k, n in counts.items()) // 2048) + 2
