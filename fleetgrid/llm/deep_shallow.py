"""Deep-shallow sorting of byte strings of equal width, with the common prefix of neighbours.

Strings are first partitioned word by word, as a multikey quicksort does: only
runs that are still tied go on to the next word, down to a shallow depth.
Runs that are tied beyond it share long prefixes and are ordered by a blind
trie, which looks only at the bytes where its strings part.
"""

from __future__ import annotations

import numpy as np

SHALLOW_WORDS = 10  # 80 bytes
_STEPS = np.array([1 << (8 * k) for k in range(1, 8)], np.uint64)


class _Fork:
    __slots__ = ("depth", "kids")

    def __init__(self, depth: int, kids: dict):
        self.depth, self.kids = depth, kids


class _Leaf:
    __slots__ = ("string", "rows")

    def __init__(self, string: bytes, row: int):
        self.string, self.rows = string, [row]


def mismatch(a: bytes, b: bytes) -> int:
    """The place of the first differing byte of two strings of equal width; the width when they are equal."""
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], rows: list[int]):
    """The rows in the order of their strings, and each one's common prefix with the one before (-1 for the first)."""
    root = _Leaf(strings[0], rows[0])
    for string, row in zip(strings[1:], rows[1:], strict=True):
        node = root
        while isinstance(node, _Fork):  # blind: bytes between the forks are skipped
            node = node.kids.get(string[node.depth]) or next(iter(node.kids.values()))
        at = mismatch(string, node.string)
        if at == len(string):
            node.rows.append(row)
            continue
        other = node.string
        above, node = None, root
        while isinstance(node, _Fork) and node.depth < at:
            above, node = node, node.kids[string[node.depth]]
        if isinstance(node, _Fork) and node.depth == at:
            node.kids[string[at]] = _Leaf(string, row)
            continue
        fork = _Fork(at, {other[at]: node, string[at]: _Leaf(string, row)})
        if above is None:
            root = fork
        else:
            above.kids[string[above.depth]] = fork
    order, shared = [], []
    todo = [(root, -1)]
    while todo:
        node, before = todo.pop()
        if isinstance(node, _Leaf):
            order += node.rows
            shared += [before] + [len(node.string)] * (len(node.rows) - 1)
        else:
            kids = [node.kids[k] for k in sorted(node.kids)]
            todo += [(kid, node.depth) for kid in reversed(kids[1:])]
            todo.append((kids[0], before))
    return order, shared


def sort(groups: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (group, string) and each one's common prefix with the one before, -1 where the group changes.

    ``strings`` is a matrix of bytes whose width is a multiple of eight.
    """
    n, width = strings.shape
    words = strings.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    shared = np.full(n, -1, np.int64)
    tied = np.zeros(n + 1, bool)  # with the one before
    tied[1:n] = groups[order][1:] == groups[order][:-1]
    for word in range(min(SHALLOW_WORDS, words.shape[1])):
        open_ = np.flatnonzero(tied[:-1] | tied[1:])
        if not len(open_):
            return order, shared
        run = np.cumsum(~tied[:-1])[open_]
        key = words[order[open_], word]
        by = np.lexsort((key, run))
        order[open_], key = order[open_][by], key[by]
        same_run = np.concatenate(([False], run[1:] == run[:-1]))
        apart = np.concatenate((np.zeros(1, np.uint64), key[1:] ^ key[:-1]))
        parted = same_run & (apart != 0)
        shared[open_[parted]] = 8 * word + 7 - np.searchsorted(_STEPS, apart[parted], side="right")
        tied[open_[parted]] = False
    starts = np.flatnonzero(~tied[:-1] & tied[1:])
    for start in starts.tolist():
        end = start + 1
        while tied[end]:
            end += 1
        rows = order[start:end].tolist()
        ordered, common = blind_trie([strings[r].tobytes() for r in rows], rows)
        order[start:end] = ordered
        shared[start + 1:end] = common[1:]
    return order, shared
