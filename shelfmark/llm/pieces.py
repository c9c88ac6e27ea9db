"""Texts to byte-level BPE ids in bulk: pieces are found and looked up in numpy, only unknown pieces reach an encoder.

Pieces follow the public pattern of byte-level BPE:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Runs of a character class make pieces; one blank before a run
belongs to it; white space before a run gives up its last character; a lone apostrophe takes the endings above.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache, lru_cache

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

SPACE, LETTER, NUMBER, OTHER = range(4)
STEP = np.uint64(0x9E3779B97F4A7C15)
SLOTS = 1 << 21
MAX_PIECES = 1 << 20
USUAL_BITS = 20  # powers for 1 MB; a longer slice or text takes the next power of two


@cache
def class_table() -> np.ndarray:
    """Class of every code point; where two Unicode versions differ, as the tokenizers library has it."""
    table = np.full(0x110000, OTHER, np.uint8)
    for block in range(0, 0x110000, 0x10000):
        text = "".join(chr(c) for c in range(block, block + 0x10000) if not 0xD800 <= c < 0xE000)
        skip = np.array([c for c in range(block, block + 0x10000) if not 0xD800 <= c < 0xE000])
        for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, text):
                table[skip[m.start() : m.end()]] = kind
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for c in range(0x110000):
        older = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
        if table[c] not in (older, SPACE):
            alone = lambda x, c=c: len(split(x + chr(c) + x)) > 1
            table[c] = LETTER if not alone("a") else NUMBER if not alone("1") else OTHER
    return table


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    step, back = int(STEP), pow(int(STEP), -1, 1 << 64)
    up, down = np.empty(n + 1, np.uint64), np.empty(n + 1, np.uint64)
    for out, factor in ((up, step), (down, back)):
        out[:] = np.uint64(factor)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return up, down


def piece_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions where pieces start; ``begins``: where non-empty texts start."""
    n = len(points)
    kind = class_table()[points]
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[n] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(run)
    starts = np.zeros(n + 4, bool)
    blank = kind[at] == SPACE
    starts[at[blank]] = True
    solid = at[~blank]
    follows = np.zeros(len(solid), bool)
    inner = ~first[solid]
    follows[inner] = kind[solid[inner] - 1] == SPACE
    starts[solid[~follows]] = True
    before = solid[follows] - 1
    starts[before] = True
    starts[solid[follows][points[before] != 32]] = True
    # Endings after a lone apostrophe.
    quote = solid[(points[solid] == 39) & starts[solid]]
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    one = padded[quote + 1]
    same = lambda at: (at < n) & ~first[np.minimum(at, n)]
    single = np.isin(one, [ord(c) for c in "stmd"]) & same(quote + 1)
    two = padded[quote + 2]
    double = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        double |= (one == ord(a)) & (two == ord(b))
    double &= same(quote + 1) & same(quote + 2)
    for some, size in ((quote[single], 2), (quote[double], 3)):
        starts[some + 1] = False
        after = some + size
        after = after[(after < n)]
        starts[after] = True
    return np.flatnonzero(starts[:n])


class PieceEncoder:
    """Ids of whole texts; known pieces are held in numpy tables of bounded size, found by a hash and compared byte by byte."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self.reset()

    def reset(self) -> None:
        self.slot = np.full(SLOTS, -1, np.int32)
        self.keys, self.text, self.ids = Growing(np.uint64), Growing(np.uint8), Growing(np.int32)
        self.text_at, self.ids_at = Growing(np.int64, [0]), Growing(np.int64, [0])

    def add(self, keys: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Encode pieces and append them to the tables; gives their numbers."""
        encoded = self.encode(pieces)
        number = self.keys.size + np.arange(len(pieces))
        self.keys.append(keys)
        self.text_at.append(self.text.size + np.cumsum([len(p) for p in pieces]))
        self.text.append(np.frombuffer(b"".join(pieces), np.uint8))
        self.ids_at.append(self.ids.size + np.cumsum([len(e) for e in encoded]))
        self.ids.append(np.array([i for e in encoded for i in e], np.int32))
        return number

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for each text the position after its last one."""
        joined = b"".join(texts)
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(joined, np.uint8)
        points = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4")
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each code point
        begin = np.cumsum(sizes) - sizes
        starts = lead[piece_starts(points, np.searchsorted(lead, begin[sizes > 0]))]
        ends = np.append(starts[1:], len(data))
        up, down = powers(1 << max(USUAL_BITS, (len(data) - 1).bit_length()))
        total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        key = (total[ends] - total[starts]) * down[starts]
        key ^= key >> np.uint64(32)
        known = self.look_up(key, data, starts, ends)
        ids_at = self.ids_at.values
        count = ids_at[known + 1] - ids_at[known]
        ids = self.ids.values[spread(ids_at[known], count)]
        after = np.concatenate([[0], np.cumsum(count)])
        return ids, after[np.searchsorted(starts, begin + sizes)]

    def look_up(self, key, data, starts, ends) -> np.ndarray:
        place = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        known = self.slot[place].astype(np.int64)
        hit = known >= 0
        hit[hit] = self.keys.values[known[hit]] == key[hit]
        missed = np.flatnonzero(~hit)
        raw = data.tobytes()
        cut = lambda at: [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        if len(missed):
            if self.keys.size > MAX_PIECES:
                self.reset()
                return self.look_up(key, data, starts, ends)
            new, first, which = np.unique(key[missed], return_index=True, return_inverse=True)
            number = self.add(new, cut(missed[first]))
            self.slot[(new & np.uint64(SLOTS - 1)).astype(np.int64)] = number
            known[missed] = number[which]
        # The piece itself, not only its hash, must be the known one: other pieces of that hash get entries that no slot names.
        other = np.flatnonzero(~self.same(known, data, starts, ends))
        if len(other):
            pieces = cut(other)
            place_of = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
            number = self.add(np.zeros(len(place_of), np.uint64), list(place_of))
            known[other] = number[[place_of[p] for p in pieces]]
        return known

    def same(self, known, data, starts, ends) -> np.ndarray:
        """Whether each piece is the known one, byte for byte."""
        text_at = self.text_at.values
        size = ends - starts
        same = (text_at[known + 1] - text_at[known]) == size
        at = np.flatnonzero(same)
        differs = self.text.values[spread(text_at[known[at]], size[at])] != data[spread(starts[at], size[at])]
        if differs.any():
            owner = np.repeat(at, size[at])
            same[owner[differs]] = False
        return same


class Growing:
    """An array that grows by doubling."""

    def __init__(self, kind, first=()):
        self.room = np.array(first, kind) if len(first) else np.zeros(1, kind)
        self.size = len(first)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]

    def append(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.room):
            room = np.zeros(max(need, 2 * len(self.room)), self.room.dtype)
            room[: self.size] = self.values
            self.room = room
        self.room[self.size : need] = more
        self.size = need


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    total = int(sizes.sum())
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(total)
