"""Benchmark decontamination by Wu-Manber search for windows of consecutive words.

A text becomes its words (A-Z in lower case; runs of anything but ASCII letters, digits and non-ASCII characters part them) with one space
around each. A benchmark item gives every run of ``window`` consecutive words, or all its words if it has fewer. These test strings are
searched in bytes: a shift table over hashed 8-byte blocks skips impossible positions, the block at a string's shortest-length end and its
first bytes select a bucket, and direct comparison confirms. Many positions of the joined texts advance side by side in numpy.

The strings are handled in blocks of ``BLOCK_BYTES`` of benchmark text: each is broadcast (so the broadcast has a fixed size) and searched in
its own pass without a shuffle; hits add up in the row.

Defined results: null and empty texts have no words and are not contaminated. An empty benchmark hits nothing. Repeated items and repeated
rows count as they stand: an item id once, each document row for itself. Other columns are carried or ignored as asked.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import as_rows, row_type, slices

WINDOW = 13
BLOCK_BYTES = 4 << 20
LANE = 2048
TABLE_BITS = 20
MIX = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that part words become spaces, A-Z become a-z.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def windows(items: list[tuple[str, bytes]], window: int = WINDOW) -> dict[bytes, tuple[int, set[str]]]:
    """Test string to its number of words and the items that hold it."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            found.setdefault(b" " + b" ".join(words[i : i + n]) + b" ", (n, set()))[1].add(item)
    return found


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as integers; ``data`` has eight spare bytes at its end."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


class Searcher:
    """Wu-Manber tables for strings of similar length (from a power of two up to the next)."""

    def __init__(self, strings: list[bytes]):
        self.m = min(map(len, strings))
        self.block = min(8, self.m)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.data = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        load = eights(self.data)
        self.shift = np.full(1 << TABLE_BITS, self.m - self.block + 1, np.int32)
        for j in range(self.m - self.block + 1):  # later blocks have smaller shifts and overwrite
            at = self.slot(load[self.starts + j])
            self.shift[at] = np.minimum(self.shift[at], self.m - self.block - j)
        key = self.bucket(load[self.starts + self.m - self.block], load[self.starts])
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (((block & self.mask) * MIX) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def bucket(self, suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return ((suffix & self.mask) * MIX) ^ ((prefix & self.mask) * np.uint64(0xC2B2AE3D27D4EB4F))

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts in ``data`` (eight spare bytes at its end) and numbers of the strings found there."""
        size = len(data) - 8
        load = eights(data)
        at = np.arange(0, max(0, size - self.m + 1), LANE)
        stop = np.minimum(at + LANE, size - self.m + 1)
        out = []
        while len(at):
            end = at + (self.m - self.block)
            step = self.shift[self.slot(load[end])]
            if (zero := step == 0).any():
                out.append(self.compare(load, at[zero], end[zero]))
            at = at + np.maximum(step, 1)
            if not (live := at < stop).all():
                at, stop = at[live], stop[live]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def compare(self, load: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.bucket(load[end], load[at])
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        n = high - low
        at, first = np.repeat(at, n), np.repeat(low, n)
        which = self.order[first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)]
        own, length = eights(self.data), self.lengths[which]
        fits = at + length <= len(load) - 1
        at, which, length = at[fits], which[fits], length[fits]
        for k in range(0, int(length.max(initial=0)), 8):
            left = np.clip(length - k, 0, 8)
            mask = np.where(left == 8, np.uint64(2**64 - 1), (np.uint64(1) << (np.uint64(8) * (left % 8).astype(np.uint64))) - np.uint64(1))
            same = (load[np.minimum(at + k, len(load) - 1)] ^ own[np.minimum(self.starts[which] + k, len(own) - 1)]) & mask == 0
            at, which, length = at[same], which[same], length[same]
        return at, which


class Tables:
    """All test strings of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        found = windows(items, window)
        classes: dict[int, list[bytes]] = {}
        for s in found:
            classes.setdefault(len(s).bit_length(), []).append(s)
        self.searchers = [(Searcher(own), np.array([found[s][0] for s in own]), [found[s][1] for s in own]) for own in classes.values()]

    def hits(self, texts: list[bytes]) -> list[tuple[list[tuple[int, int]], set[str], int]]:
        """Per text: runs of hit words, items that occur, number of words."""
        words = [words_of(t) for t in texts]
        joined = [b" " + b" ".join(w) + b" " if w else b"" for w in words]
        data = np.frombuffer(b"\n".join(joined) + bytes(9), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(j) + 1 for j in joined])])
        runs: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        spaces = None
        for searcher, counts, owners in self.searchers:
            at, which = searcher.find(data)
            if not len(at):
                continue
            if spaces is None:
                spaces = np.flatnonzero(data == 32)
            doc = np.searchsorted(begins, at, "right") - 1
            word = np.searchsorted(spaces, at) - np.searchsorted(spaces, begins[doc])
            for d, w, k in zip(doc.tolist(), word.tolist(), which.tolist(), strict=True):
                runs[d].append((w, w + int(counts[k])))
                items[d] |= owners[k]
        return [(merged(r), i, len(w)) for r, i, w in zip(runs, items, words, strict=True)]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_BUILT: dict[str, Tables] = {}


def tables_of(name: str, broadcast, window: int) -> Tables:
    """Tables of a broadcast block, built once a worker; only one block's are held."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Tables(broadcast.value, window)
    return _BUILT[name]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Blocks of items, each of bounded size, one at a time."""
    own = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for k in range(n):
        block = own.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else own
        yield [(r.item, r.text.encode()) for r in block.collect()]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", carry: list[str], item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, share: int = 20, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (the carried columns, which include the text), ``n_words, n_hit`` long, ``items`` (sorted as strings), ``contaminated``.

    Contaminated: some word is hit, and ``share`` times the hit words are no fewer than all words.
    """
    spark, kind = docs.sparkSession, row_type(docs, carry)
    found = f"row {kind}, n_words bigint, runs array<struct<a: bigint, b: bigint>>, items array<string>"
    rows = as_rows(docs, carry)
    run_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    for block in blocks_of(benchmark, item_col, item_text_col, block_bytes):
        shared, name = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches, shared=shared, name=name):
            tables = tables_of(name, shared, window)
            for batch, texts in slices(batches, text_col):
                hits = tables.hits(texts.to_pylist())
                runs, items = [r for r, _, _ in hits], [i for _, i, _ in hits]
                if batch.num_columns > 1:
                    runs = [merged(r + [(x["a"], x["b"]) for x in old]) for r, old in zip(runs, batch["runs"].to_pylist(), strict=True)]
                    items = [i | set(old) for i, old in zip(items, batch["items"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([n for _, _, n in hits], pa.int64()),
                        pa.array([[{"a": a, "b": b} for a, b in r] for r in runs], run_type), pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    ],
                    ["row", "n_words", "runs", "items"],
                )

        rows = rows.mapInArrow(search, found)
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda s, r: s + r.b - r.a)
    return rows.select("row", "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )
