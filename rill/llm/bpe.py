"""Byte-level BPE: exact encoding by backtracking, decoding by an offset table.

Encoding never runs the merge loop.  An Aho-Corasick automaton over the whole
vocabulary finds, in one pass, the longest token that starts at each position
of a word.  Tokens are then laid from the left: the longest one first, shorter
ones (its prefixes in the vocabulary) and steps back after that, and a token
may follow another only if the *pair-compatibility table* says that BPE itself
would keep these two apart.  A position that was given up is never tried
again, so the work is linear in the text, and the result equals that of the
merge loop.  It holds for vocabularies whose every token encodes to itself
(tested for the given file).

Decoding looks up every id in one table of token bytes with offsets and copies
the slices into one buffer.

Defined cases: a null text counts as empty; an empty text has no ids (both
digests are those of the empty string); a row is encoded on its own, so
repeated rows and ids come out repeatedly and a null doc_id stays null; further
columns of the input are ignored; text of any length is encoded whole.  Bytes
that are no valid UTF-8 are read as U+FFFD, as are ids without a text.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.llm.common import chunks, plain_text, shared_bytes, text_steps

# The word pattern of this family of byte-level vocabularies.
WORD = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
        r"| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Words that a worker remembers at most; then it starts afresh.
REMEMBERED = 600_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Tables for one vocabulary file (JSON of the tokenizers library)."""

    def __init__(self, file: bytes):
        import ahocorasick
        import regex

        spec = json.loads(file)
        model = spec["model"]
        to_byte = byte_alphabet()
        token = {i: bytes(to_byte[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for t, i in self.special.items():
            token.setdefault(i, t.encode())
        size = max(token) + 1
        self.token = [token.get(i, "�".encode()) for i in range(size)]
        self.length = [len(t) for t in self.token]
        plain = {token[i]: i for i in model["vocab"].values() if i not in self.special.values()}
        self.made, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.rank: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b, ab = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.rank[a, b], self.made[ab], self.left[ab], self.right[ab] = r, r, a, b
        self.prefix = [-1] * size           # longest shorter token it starts with
        self.longest = ahocorasick.Automaton()
        for t, i in plain.items():
            self.longest.add_word(t.decode("latin-1"), i)
            self.prefix[i] = next((plain[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in plain), -1)
        self.longest.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.find = regex.compile(WORD).findall
        parts = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({parts})").split if parts else lambda text: [text]
        self.table = pa.array(self.token, pa.binary())

    def compatible(self, a: int, b: int) -> bool:
        """Does BPE leave these two tokens apart when they stand together?

        Undo the merges next to the border, latest first.  If the tokens that
        meet at the border at some time could have merged before one of them
        was used up, BPE would have merged them.  Of equal merges the left one
        comes first.
        """
        key, until = (a, b), len(self.rank)
        if (known := self.fits.get(key)) is not None:
            return known
        fits = True
        while True:
            if self.rank.get((a, b), until) < until:
                fits = False
                break
            if self.made[a] < 0 and self.made[b] < 0:
                break
            if self.made[a] > self.made[b]:
                until, a = self.made[a], self.right[a]
            else:
                until, b = self.made[b] + 1, self.left[b]
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def word(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        text = word.encode("utf-8").decode("latin-1")
        out = [i for _, i in self.longest.iter_long(text)]
        # the usual case: the longest tokens, one after the other, all fit
        fits = self.fits.get
        for pair in zip(out, out[1:], strict=False):
            known = fits(pair)
            if not (self.compatible(*pair) if known is None else known):
                break
        else:
            return out
        first = [-1] * (len(text) + 1)
        length = self.length
        for end, i in self.longest.iter(text):     # longer matches come later
            first[end + 1 - length[i]] = i
        out = []
        given_up = bytearray(len(text) + 1)
        at, token, stop = 0, first[0], len(text)
        while at < stop:
            while token >= 0 and (given_up[at + length[token]]
                                  or out and not self.compatible(out[-1], token)):
                token = self.prefix[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = first[at]
            else:
                given_up[at] = 1
                last = out.pop()
                at -= length[last]
                token = last
        return out

    def remembered(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            got = array("i", self.word(word)).tobytes()
            if len(word) < 64:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers; strings of special tokens in it
        give their ids."""
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.remembered(text)         # one word of the pattern
        if "<" not in text:
            return b"".join(map(self.remembered, self.find(text)))
        return b"".join(array("i", [self.special[part]]).tobytes() if part in self.special
                        else b"".join(map(self.remembered, self.find(part))) for part in self.cut(text))

    def decode(self, ids: np.ndarray) -> pa.Array:
        """The bytes of each id, one after the other in one buffer."""
        inside = np.where((ids >= 0) & (ids < len(self.token)), ids, len(self.token) - 1)
        return self.table.take(pa.array(inside))


class Encoder:
    """Encodes batches of texts; equal chunks are encoded once per batch."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.digits = pa.array([b"%d," % i for i in range(len(bpe.token))], pa.large_binary())

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        cut, before = chunks(plain_text(texts))
        coded = cut.dictionary_encode()
        encode = self.bpe.encode
        own = pa.array([encode(str(c, "utf-8", "replace")) for c in coded.dictionary.to_pylist()], pa.large_binary())
        ids = own.take(coded.indices)
        if not len(ids):
            return np.zeros(0, "<i4"), before
        at = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1]
        return np.frombuffer(ids.buffers()[2], "<i4", count=int(at[-1]) // 4), at[before] // 4

    def decimal(self, ids: np.ndarray, at: np.ndarray) -> Iterator[memoryview]:
        """Each text's ids as decimal numbers joined by commas."""
        text = self.digits.take(pa.array(ids))
        if not len(text):
            yield from (memoryview(b"") for _ in at[1:])
            return
        ends, data = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1][at].tolist(), memoryview(text.buffers()[2])
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield data[a:max(a, b - 1)]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int): the tokens of every text."""
    spark = docs.sparkSession
    file = shared_bytes(spark, path)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Bpe(file.value))
        for batch in batches:
            for step in text_steps(batch):
                ids, at = encoder(step.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([step.column(0), lists], [id_col, "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text``: the text of every list of ids (null: empty)."""
    file = shared_bytes(tokens.sparkSession, path)
    rows = tokens.select(F.col(id_col), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(file.value)
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False)))
            texts = [t.decode("utf-8", "replace") for t in slices(bpe.decode(flat), at)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, text string")


def slices(tokens: pa.Array, at: np.ndarray) -> Iterator[bytes]:
    """Bytes of the tokens from each position in ``at`` to the next."""
    if not len(tokens):
        yield from (b"" for _ in at[1:])
        return
    ends = np.frombuffer(tokens.buffers()[1], np.int32)[:len(tokens) + 1][at]
    data = memoryview(tokens.buffers()[2] or b"")
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield bytes(data[a:b])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the text decoded from them, per document:
    ``id_col``, n_tokens, ids_sha256, decoded_sha256.  Both directions run in
    one pass, so the ids are neither shuffled nor stored."""
    spark: SparkSession = docs.sparkSession
    file = shared_bytes(spark, path)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(file.value)
        encoder = Encoder(bpe)
        for batch in batches:
            for step in text_steps(batch):
                ids, at = encoder(step.column("text"))
                own = [hashlib.sha256(digits).hexdigest() for digits in encoder.decimal(ids, at)]
                back = [hashlib.sha256(t.decode("utf-8", "replace").encode()).hexdigest()
                        for t in slices(bpe.decode(ids), at)]
                yield pa.RecordBatch.from_arrays(
                    [step.column(0), pa.array(np.diff(at), pa.int64()), pa.array(own, pa.string()),
                     pa.array(back, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
