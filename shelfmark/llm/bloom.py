"""Bloom filters over 64-bit hashes in numpy: once-seen and twice-seen bits that tasks build and that merge exactly.

Bits of a hash lie in one 64-bit word. A word pair (once, twice) merges with another one as (once | once', twice | twice' | once & once'),
in any order: whatever was seen in two tasks, or twice in one, has all its bits in ``twice``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS_PER_HASH = 24
MAX_WORDS = 1 << 20  # of 64 bits: 8 MB a filter
SECTION = 1 << 12


def words_for(n: int) -> int:
    words = SECTION
    while words * 64 < n * BITS_PER_HASH and words < MAX_WORDS:
        words *= 2
    return words


def places(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word number and four bits of each hash."""
    h = h.astype(np.uint64)
    mask = np.zeros(len(h), np.uint64)
    for k in range(4):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return ((h >> np.uint64(24)) & np.uint64(words - 1)).astype(np.int64), mask


class TwoFilters:
    def __init__(self, words: int):
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of one batch; a hash that the batch repeats counts as often."""
        hashes, n = np.unique(hashes, return_counts=True)
        at, mask = places(hashes, len(self.once))
        again = n > 1
        np.bitwise_or.at(self.twice, at[again], mask[again])
        # Of several hashes in one word, bits that two of them share are taken as seen twice: a false hit at worst.
        order = np.argsort(at, kind="stable")
        at, mask = at[order], mask[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        if len(at):
            own = np.bitwise_or.reduceat(mask, first)
            word = at[first]
            self.twice[word] |= self.once[word] & own
            self.once[word] |= own

    def merge(self, start: int, once: np.ndarray, twice: np.ndarray) -> None:
        part = slice(start, start + len(once))
        self.twice[part] |= twice | (self.once[part] & once)
        self.once[part] |= once

    def maybe_twice(self, hashes: np.ndarray) -> np.ndarray:
        at, mask = places(hashes, len(self.twice))
        return self.twice[at] & mask == mask


def section_rows(filters: TwoFilters, section: int = SECTION) -> pa.RecordBatch:
    """The filter pair in sections; sections without a bit are left out."""
    starts = [s for s in range(0, len(filters.once), section) if filters.once[s : s + section].any()]
    pick = lambda a: pa.array([a[s : s + section].tobytes() for s in starts], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pick(filters.once), pick(filters.twice)], ["start", "once", "twice"])


def merge_sections(rows: DataFrame, words: int, parts: int) -> np.ndarray:
    """The merged twice-seen filter. Sections merge in tasks as they stream in; the driver gets the filter once, of fixed size."""

    def merge(batches):
        own: dict[int, TwoFilters] = {}
        for batch in batches:
            for start, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair = own.setdefault(start, TwoFilters(len(once) // 8))
                pair.merge(0, np.frombuffer(once, np.uint64), np.frombuffer(twice, np.uint64))
        for start, pair in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([pair.twice.tobytes()], pa.binary())], ["start", "twice"])

    out = np.zeros(words, np.uint64)
    for r in rows.repartition(parts, "start").mapInArrow(merge, "start bigint, twice binary").toLocalIterator():
        out[r.start : r.start + len(r.twice) // 8] = np.frombuffer(r.twice, np.uint64)
    return out
