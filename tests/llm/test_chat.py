"""Formatting read back equals the conversations it was made from."""

import hashlib
import random

import pyarrow as pa

from conftest import SF_MID
from rill.llm import chat, queries
from rill.llm.common import table


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


def check(rows, got):
    want = expected(rows)
    assert {r["conv_id"]: tuple(r[1:5]) for r in got} == want and len(got) == len(want)


def test_given_conversations(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, SF_MID, "conversations").collect()]
    said = "</s>[INST] ok [/INST]"
    got = queries.op7_chat_formatting(spark, SF_MID).collect()
    check(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)], got)


def test_odd_turns(spark):
    rng = random.Random(8)
    letters = ["<", "|", "\\", "<|", "<|end|>", "<|role|>", "é", "🎉", "\n", "a"]
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 9)))
    rows = [(c, t, rng.choice(["user", "assistant", None, word()]), rng.choice([None, word(), word()]))
            for c in range(300) for t in range(rng.randint(1, 6))]
    rows += [(None, 1, "assistant", "x"), (None, 0, "user", "y"), (400, None, "assistant", "n"), (400, 0, "user", "o"),
             (401, 1, "assistant", "b"), (401, 1, "assistant", "a"), (401, 1, "assistant", "a"), (402, 0, "user", "u"),
             (403, 0, "assistant", "é" * 200_000)]
    rows += [(500, t, rng.choice(["user", "assistant"]), word()) for t in range(30_000)]       # a third of all and more
    docs = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, mask int")
    made = chat.format_turns(docs.repartition(3))
    check(rows, chat.read_back(made).collect())
    for r in made.filter("conv_id = 401").collect():
        data = r["formatted"].encode()
        assert [data[m["start"]:m["end"]] for m in r["mask"]] == [b"a", b"a", b"b"]


def test_long_conversations_come_in_bounded_segments(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{t}é<|" * 40) for c in (7, None) for t in range(12_000)]
    rows += [(8, 0, "assistant", "x" * 100_000), (8, 1, "user", "y")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_turns(docs.repartition(3))
    got = sorted(((r["conv_id"] or 0, r["segment"], r["start"], r["n_turns"], len(r["formatted"].encode())) for r in made.collect()))
    for c, n in ((0, 12_000), (7, 12_000), (8, 2)):
        mine = [r for r in got if r[0] == c]
        assert [r[1] for r in mine] == list(range(len(mine))) and sum(r[3] for r in mine) == n
        assert [r[2] for r in mine] == [sum(r[4] for r in mine[:k]) for k in range(len(mine))]
        assert c == 8 or max(r[4] for r in mine) < chat.SEGMENT + 1000
    check(rows, chat.read_back(made.repartition(4)).collect())
    check(rows, chat.read_back(made, in_order=True).collect())


def test_escape_is_reversible():
    texts = pa.array(["", "<|", "<\\|", "\\<|", "<\\\\|", "\\\\", "<", "|", "<<||", "\\|<"])
    escaped = chat.escape(texts)
    assert not any("<|" in t for t in escaped.to_pylist())
    assert chat.unescape(escaped).equals(texts) and len(set(escaped.to_pylist())) == len(texts)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(empty)).count() == 0
