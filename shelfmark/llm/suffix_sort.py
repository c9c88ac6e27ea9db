"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries below it.

Strings come as rows of equal width. Quicksort parts rows in three by one eight-byte symbol at a time; rows that agree in all symbols down to the
shallow depth form groups with a long common prefix, which a blind trie orders: it branches only where strings differ and compares each new
string with one leaf. The result is the order and the length of the common prefix of neighbours.
"""

from __future__ import annotations

import numpy as np

SMALL = 24


def symbols(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian eight-byte numbers, filled up with zero bytes; the width is a multiple of eight."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def shallow_groups(columns: np.ndarray) -> list[np.ndarray]:
    """Row numbers in the order of all columns, in groups of equal rows, by multikey quicksort."""
    n, depth = columns.shape
    columns = np.ascontiguousarray(columns.T)
    groups: list[np.ndarray] = []
    stack = [(np.arange(n), 0)] if n else []
    while stack:
        rows, at = stack.pop()
        if at == depth or len(rows) == 1:
            groups.append(rows)
            continue
        key = columns[at, rows]
        if len(rows) <= SMALL:
            order = np.lexsort(columns[at:, rows][::-1])
            rows = rows[order]
            apart = (columns[at:, rows[1:]] != columns[at:, rows[:-1]]).any(axis=0)
            groups += np.split(rows, np.flatnonzero(apart) + 1)
            continue
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        less, more = key < pivot, key > pivot
        if more.any():
            stack.append((rows[more], at))
        stack.append((rows[~(less | more)], at + 1))
        if less.any():
            stack.append((rows[less], at))
    return groups


class BlindTrie:
    """Orders different strings of one length; inner nodes are ``[depth, {byte: child}]``, leaves are numbers of strings."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, 0
        self.bits = 8 * len(strings[0])
        self.numbers = [int.from_bytes(s, "big") for s in strings]
        for k in range(1, len(strings)):
            self.insert(k)

    def insert(self, k: int) -> None:
        own, node = self.strings[k], self.root
        while not isinstance(node, int):  # blind: only branching bytes are looked at
            node = node[1].get(own[node[0]]) if own[node[0]] in node[1] else next(iter(node[1].values()))
        differ = (self.bits - (self.numbers[k] ^ self.numbers[node]).bit_length()) // 8
        other = self.strings[node][differ]
        above, node = None, self.root
        while not isinstance(node, int) and node[0] < differ:
            above, node = node, node[1][own[node[0]]]
        if not isinstance(node, int) and node[0] == differ:
            node[1][own[differ]] = k
            return
        new = [differ, {other: node, own[differ]: k}]
        if above is None:
            self.root = new
        else:
            above[1][own[above[0]]] = new

    def walk(self) -> tuple[list[int], list[int]]:
        """Strings in order, and the common prefix of each with the one before it (0 for the first)."""
        order, common = [], []
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            if isinstance(node, int):
                order.append(node)
                common.append(depth)
                continue
            # The first child keeps what its parent shares with the string before it.
            children = sorted(node[1].items())
            stack += [(child, node[0] if j else depth) for j, (_, child) in reversed(list(enumerate(children)))]
        return order, common


def sort_rows(rows: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the common prefix in bytes of each row with the one before it in that order (0 for the first).

    Equal rows are sorted as one and stand side by side in their given order.
    """
    n, width = rows.shape
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    columns = symbols(rows)
    depth = min(shallow // 8, columns.shape[1])
    order: list[np.ndarray] = []
    known: list[np.ndarray] = []
    deep = [[] for _ in range(2)]
    groups = shallow_groups(columns[:, :depth])
    singles = np.array([g[0] for g in groups])
    shared = np.zeros(len(groups), np.int64)
    if len(groups) > 1:  # neighbours of different groups differ above the shallow depth
        a, b = columns[singles[:-1], :depth], columns[singles[1:], :depth]
        first = (a != b).argmax(axis=1)
        x = a[np.arange(len(a)), first] ^ b[np.arange(len(a)), first]
        lead = np.zeros(len(x), np.int64)
        for byte in range(7, -1, -1):
            lead[(x >> np.uint64(8 * byte)) == 0] = 8 - byte
        shared[1:] = 8 * first + lead
    del deep
    for g, s in zip(groups, shared.tolist(), strict=True):
        if len(g) == 1:
            order.append(g)
            known.append(np.array([s]))
            continue
        raw = [rows[i].tobytes() for i in g.tolist()]
        same: dict[bytes, list[int]] = {}
        for i, r in zip(np.sort(g).tolist(), [raw[k] for k in np.argsort(g).tolist()], strict=True):
            same.setdefault(r, []).append(i)
        strings = list(same)
        places, common = BlindTrie(strings).walk() if len(strings) > 1 else ([0], [0])
        for j, (p, c) in enumerate(zip(places, common, strict=True)):
            equal = same[strings[p]]
            order.append(np.array(equal))
            known.append(np.array([c if j else s] + [width] * (len(equal) - 1)))
    return np.concatenate(order), np.concatenate(known)
