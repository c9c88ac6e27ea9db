"""Contracts word by word, byte by byte and link by link, for the tests."""

from __future__ import annotations

import hashlib

from shelfmark.llm.decontaminate import WINDOW, windows, words_of
from shelfmark.llm.suffix_dedup import LENGTH


def reach(nodes, links) -> dict:
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def contamination(docs: list[tuple[int, str | None]], items: list[tuple[str, str | None]], window: int = WINDOW) -> list[tuple]:
    """The contract word by word."""
    tests = windows([(str(i), t.encode()) for i, t in items if t is not None], window)
    lengths = sorted({n for n, _ in tests.values()})
    out = []
    for doc, text in docs:
        words = words_of((text or "").encode())
        hit, own = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if found := tests.get(b" " + b" ".join(words[i : i + n]) + b" "):
                    hit |= set(range(i, i + n))
                    own |= found[1]
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(own), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return out


def repeats(docs: list[tuple[int, bytes]], length: int = LENGTH) -> list[tuple]:
    """Window by window; documents in order."""
    seen: set[bytes] = set()
    out = []
    for doc, text in docs:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if (w := text[k : k + length]) in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
