"""BagMinHash signatures of multisets of word shingles, in numpy.

A shingle that occurs w times in a text has weight w.  The weights are
discretised into integer levels, and these into blocks [0,1), [1,2), [2,4),
[4,8), ...  Every block of every shingle is an independent Poisson process
whose points have a time, a register and a level inside the block (a point of
a block is handed down to its levels, so blocks that a weight covers in part
give exactly the points below it).  Its rate is the block's width per register.
The signature keeps, per register, the identity of the earliest point: two
texts agree in a register with the probability of their weighted Jaccard
similarity.  Points come in order of time, so each process stops at a time by
which all registers are filled; texts with an empty register go on with a
later time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from rill.llm.common import plain_text, raw, to_binary

WORDS_PER_SHINGLE = 5
REGISTERS = 96
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_EVEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that scatters 64-bit integers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes (cut at blanks) and shingles that are worked on at once.
PIECE_BYTES, PIECE_SHINGLES = 2 << 20, 1 << 18


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code of every word, and each text's first word.  Long texts are
    read piece by piece; no word crosses a blank."""
    ends, data = raw(plain_text(texts))
    codes, before, begin = [np.zeros(0, np.uint64)], np.zeros(len(texts) + 1, np.int64), 0
    while begin < len(data):
        stop = min(begin + PIECE_BYTES, len(data))
        while stop < len(data):                         # on to the next blank
            blank = np.flatnonzero(_BLANK[data[stop:stop + PIECE_BYTES]])
            if len(blank):
                stop += int(blank[0])
                break
            stop = min(stop + PIECE_BYTES, len(data))
        cut = np.clip(ends, begin, stop) - begin
        code, first = _piece_codes(cut, data[begin:stop])
        before += first
        codes.append(code)
        begin = stop
    return np.concatenate(codes), before


def _piece_codes(ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of some texts, given by their ends, and how many words
    begin before each end."""
    inside = ~_BLANK[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(data)]
    start[first] = inside[first]
    at = np.flatnonzero(start)
    before = np.searchsorted(at, ends)
    place = np.cumsum(inside) - 1
    words = to_binary(np.append(place[at], place[-1] + 1), data[inside]).dictionary_encode()
    code = np.array([xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()], np.uint64)
    return code[words.indices.to_numpy()] if len(code) else np.zeros(0, np.uint64), before


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, code and weight of every different shingle, sorted by owner and
    code.  A text of fewer words is one shingle."""
    code, at = word_codes(texts)
    count = np.diff(at)
    windows = np.where(count >= WORDS_PER_SHINGLE, count - WORDS_PER_SHINGLE + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(count)), windows)
    skipped = at[:-1] - (np.cumsum(windows) - windows)          # words before a text less windows before it
    hashed = np.zeros(len(owner), np.uint64)
    for a in range(0, len(owner), PIECE_SHINGLES):
        mine = owner[a:a + PIECE_SHINGLES]
        first = skipped[mine] + np.arange(a, a + len(mine))
        h = hashed[a:a + PIECE_SHINGLES]
        for k in range(WORDS_PER_SHINGLE):
            there = first + k < at[1:][mine]
            h = mix(h + np.where(there, code[np.minimum(first + k, len(code) - 1)], 0) + _EVEN)
        hashed[a:a + PIECE_SHINGLES] = h
    order = np.lexsort((hashed, owner))
    owner, hashed = owner[order], hashed[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
    begin = np.flatnonzero(new)
    weight = np.diff(np.append(begin, len(owner)))
    return owner[begin], hashed[begin], weight


def signatures(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """(texts, REGISTERS) 32-bit point identities; texts without shingles have
    zeros."""
    m = REGISTERS
    total = np.bincount(owner, weight, texts)
    best = np.full(texts * m, np.iinfo(np.uint64).max, np.uint64)
    missing = total > 0
    until = np.divide(np.log(m) + 4, total, out=np.zeros(texts), where=missing)
    while missing.any():
        mine = missing[owner]
        o, c, w = owner[mine], code[mine], weight[mine]
        level, low = 0, 0
        while len(o):
            width = max(1, low)
            for a in range(0, len(o), PIECE_SHINGLES):
                part = slice(a, a + PIECE_SHINGLES)
                _points(best, o[part], mix(c[part] + np.uint64(level * int(_EVEN) % 2**64)), w[part], low, width, until)
            low, level = low + width, level + 1
            more = w > low
            o, c, w = o[more], c[more], w[more]
        missing &= (best.reshape(texts, m) == np.iinfo(np.uint64).max).any(1)
        until *= 3
    best[best == np.iinfo(np.uint64).max] = 0
    return (best & np.uint64(0xFFFFFFFF)).astype("<u4").reshape(texts, m)


def _points(best: np.ndarray, owner: np.ndarray, seed: np.ndarray, weight: np.ndarray, low: int, width: int,
            until: np.ndarray) -> None:
    """Run the processes of one block level of many shingles."""
    time = np.zeros(len(owner))
    step = 0
    scale = 1.0 / (REGISTERS * width)
    while len(owner):
        step += 1
        draw = mix(seed + np.uint64(step * int(_EVEN) % 2**64))
        time = time - np.log(((draw >> np.uint64(24)) + np.uint64(1)).astype("f8") * 2.0 ** -40) * scale
        on = time < until[owner]
        owner, seed, weight, time, draw = owner[on], seed[on], weight[on], time[on], draw[on]
        register = ((draw & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS)) >> np.uint64(24)
        again = mix(draw + _EVEN)
        use = slice(None)
        if width > 1:                           # the level that the point falls to
            use = low + ((again >> np.uint64(40)) * np.uint64(width) >> np.uint64(24)).astype(np.int64) < weight
        packed = time[use].astype("f4").view(np.uint32).astype(np.uint64) << np.uint64(32)
        packed |= again[use] & np.uint64(0xFFFFFFFF)
        np.minimum.at(best, owner[use] * REGISTERS + register[use].astype(np.int64), packed)


def similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the texts of each row (0 if one has
    no word)."""
    rows = len(left)
    lo, lc, lw = shingles(left)
    ro, rc, rw = shingles(right)
    owner, code = np.concatenate([lo, ro]), np.concatenate([lc, rc])
    weight = np.concatenate([lw, rw])
    order = np.lexsort((code, owner))
    owner, code, weight = owner[order], code[order], weight[order]
    both = np.flatnonzero((owner[1:] == owner[:-1]) & (code[1:] == code[:-1]))
    shared = np.bincount(owner[both], np.minimum(weight[both], weight[both + 1]), rows)
    whole = np.bincount(owner, weight, rows) - shared
    return np.divide(shared, whole, out=np.zeros(rows), where=whole > 0)
