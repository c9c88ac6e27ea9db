"""BPE by backtracking, and decoding by an offset table.

An Aho-Corasick automaton gives the longest token from each byte of a piece. Tokens are taken greedily; a token may follow another only if
the two are compatible, that is, if merging their joined bytes gives just these two. If a token doesn't fit, its next shorter prefix token is
tried; if none fits, the last token is taken back and its position is never entered again. Each position is left at most once, so the time is
linear, and the result is exactly that of the merges in order. Compatible pairs are remembered in a table of bounded size.

Defined results: null and empty texts give no ids. A special token's text gives its id, as the public library has it by default. Unknown
bytes cannot occur: every byte is a token. Repeated rows are each encoded. Other columns are carried or ignored as asked.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import tokenizer_file
from .pieces import PieceEncoder, spread
from .rows import as_rows, row_type, slices

VOCABULARY = "byte_bpe_50k.json"
MAX_PAIRS = 1 << 18
SLICE = 1 << 20


def byte_characters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one vocabulary file. Inside, tokens are numbered by rank: bytes first, then merges in order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        chars, vocabulary = byte_characters(), spec["model"]["vocab"]
        to_bytes = lambda s: bytes(chars[c] for c in s)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        names = [c for c in chars] + [a + b for a, b in merges]
        rank = {name: i for i, name in enumerate(names)}
        self.id_of = np.array([vocabulary[n] for n in names], np.int32)
        self.bytes_of = [to_bytes(n) for n in names]
        self.size = [len(b) for b in self.bytes_of]
        self.halves = [(i, i) for i in range(256)] + [(rank[a], rank[b]) for a, b in merges]
        self.merged = {(rank[a], rank[b]): 256 + i for i, (a, b) in enumerate(merges)}
        by_bytes = {b: i for i, b in enumerate(self.bytes_of)}
        self.shorter = [next((by_bytes[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in by_bytes), -1) for b in self.bytes_of]
        self.automaton = ahocorasick.Automaton()
        for i, b in enumerate(self.bytes_of):
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}

        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        by_id = {int(i): b for i, b in zip(self.id_of, self.bytes_of, strict=True)} | {i: s.encode() for s, i in self.special.items()}
        table = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.table_at = np.concatenate([[0], np.cumsum([len(b) for b in table])])
        self.decimals = [b"%d" % i for i in range(len(table))]
        self.bulk = PieceEncoder(lambda pieces: [self.encode_piece(p) for p in pieces])

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.fits.get((a, b))) is None:
            if len(self.fits) >= MAX_PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = self.check(a, b)
        return known

    def check(self, a: int, b: int) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before the merges that make them.

        The later of the two merges is undone step by step; a merge across the border at that stage must not be due already.
        """
        due = len(self.halves)
        while True:
            if self.merged.get((a, b), due) < due:
                return False
            left, right = a >= 256, b >= 256
            if not left and not right:
                return True
            if left and (a > b or not right):
                due, a = a, self.halves[a][1]
            else:  # at equal ranks the left one merges first, so a merge of the same rank is still ahead
                due, b = b + 1, self.halves[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        n = len(piece)
        longest = [0] * n
        size = self.size
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size[token] + 1] = token  # ends come in order, so the last one is the longest
        open_, out, at, token = bytearray(b"\1") * (n + 1), [], 0, longest[0] if n else -1
        while token >= 0:
            last = out[-1] if out else -1
            while True:
                end = at + size[token]
                if open_[end] and (last < 0 or self.compatible(last, token)):
                    out.append(token)
                    at = end
                    token = longest[end] if end < n else -1
                    break
                if (less := self.shorter[token]) >= 0:
                    token = less
                    continue
                open_[at] = 0
                out.pop()
                at -= size[last]
                token = last
                break
        return self.id_of[out].tolist()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of whole texts."""
        parts, owner, marks = [], [], {}
        for i, text in enumerate(texts):
            if self.split is not None and any(s.encode() in text for s in self.special):
                found = self.split.split(text.decode())
                marks[i] = found
                own = [x.encode() for x in found[::2]]
            else:
                own = [text]
            parts += own
            owner.append(len(own))
        ids, after = self.bulk(parts)
        before = np.concatenate([[0], after[:-1]])
        out, k = [], 0
        for i, n in enumerate(owner):
            if i in marks:
                own = []
                for j in range(n):
                    own.append(ids[before[k + j] : after[k + j]])
                    if 2 * j + 1 < len(marks[i]):
                        own.append(np.array([self.special[marks[i][2 * j + 1]]], np.int32))
                out.append(np.concatenate(own))
            else:
                out.append(ids[before[k] : after[k]])
            k += n
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of the ids; bytes that aren't UTF-8 become the replacement character."""
        size = self.table_at[ids + 1] - self.table_at[ids]
        raw = self.table[spread(self.table_at[ids], size)].tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = raw.decode(errors="replace").encode()
        return raw

    def digest(self, ids: np.ndarray) -> str:
        decimals = self.decimals
        return hashlib.sha256(b",".join([decimals[i] for i in ids.tolist()])).hexdigest()


@cache
def bpe_of(vocabulary: str) -> Bpe:
    return Bpe(tokenizer_file(vocabulary))


def encode_and_decode(docs: DataFrame, *, text_col: str = "text", carry: list[str], vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (the carried columns, which include the text), ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; with ``keep`` also ``ids`` or ``decoded``.

    No shuffle: every text is encoded where it is read.
    """
    wanted = {"ids": "array<int>", "decoded": "string"}
    extra = [k for k in wanted if k in keep]

    def work(batches):
        bpe = bpe_of(vocabulary)
        for batch, texts in slices(batches, text_col, SLICE):
            encoded = bpe.encode(texts.to_pylist())
            decoded = [bpe.decode(e) for e in encoded]
            made = {
                "ids": lambda e=encoded: pa.array(e, pa.list_(pa.int32())),
                "decoded": lambda d=decoded: pa.array(d, pa.binary()).cast(pa.string()),
            }
            columns = [
                batch.column(0), pa.array([len(e) for e in encoded], pa.int64()), pa.array([bpe.digest(e) for e in encoded], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()), *[made[k]() for k in extra],
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_tokens", "ids_sha256", "decoded_sha256", *extra])

    kinds = "".join(f", {k} {wanted[k]}" for k in extra)
    return as_rows(docs, carry).mapInArrow(work, f"row {row_type(docs, carry)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{kinds}")
