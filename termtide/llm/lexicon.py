"""A minimal acyclic transducer from words to token ids, in flat arrays that tasks map from a file.

Words go in sorted order into an automaton whose equal suffixes are shared. The outputs along a word's
edges add up to the word's number, and the number gives its ids, so shared suffixes can end words with
different ids. Lookups walk all words of a batch at once, one byte a step.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np

#: The arrays of a compiled lexicon in file order.
PARTS = (("edges", np.int64), ("targets", np.int32), ("skips", np.int32), ("accepts", np.int8), ("starts", np.int64), ("ids", np.int32))


def _automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Transitions and final flags of the minimal automaton of sorted distinct words; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # unregistered edges of the last word: from, byte, to

    def settle(keep: int) -> None:
        while len(path) > keep:
            parent, byte, child = path.pop()
            shape = (final[child], tuple(sorted(moves[child].items())))
            moves[parent][byte] = register.setdefault(shape, child)

    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        settle(common)
        at = path[-1][2] if path else 0
        for byte in word[common:]:
            moves.append({})
            final.append(False)
            moves[at][byte] = len(moves) - 1
            path.append((at, byte, len(moves) - 1))
            at = len(moves) - 1
        final[at] = True
        last = word
    settle(0)
    return moves, final


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file of a lexicon: six array lengths, then the arrays."""
    words = sorted(entries)
    moves, final = _automaton(words)
    order, number, stack = [], {0: 0}, [0]
    while stack:  # number the states that are left, and visit children before parents
        state = stack.pop()
        order.append(state)
        for child in moves[state].values():
            if child not in number:
                number[child] = len(number)
                stack.append(child)
    under: dict[int, int] = {}

    def count(root: int) -> int:
        todo = [root]
        while todo:
            state = todo[-1]
            if wait := [c for c in moves[state].values() if c not in under]:
                todo += wait
            else:
                under[state] = final[state] + sum(under[c] for c in moves[state].values())
                todo.pop()
        return under[root]

    count(0)
    edges, targets, skips = [], [], []
    for state in sorted(order, key=number.get):
        passed = int(final[state])
        for byte, child in sorted(moves[state].items()):
            edges.append(number[state] * 256 + byte)
            targets.append(number[child])
            skips.append(passed)
            passed += under[child]
    accepts = [final[s] for s in sorted(order, key=number.get)]
    starts = np.cumsum([0, *(len(entries[w]) for w in words)])
    arrays = (edges, targets, skips, accepts, starts, [i for w in words for i in entries[w]])
    arrays = [np.asarray(a, dtype=t) for a, (_, t) in zip(arrays, PARTS, strict=True)]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped from a file in the task's own temporary folder.

    The file has no name once it is mapped, so that nothing stays behind; another task writes its own.
    """

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(blob)
            file.flush()
            view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        at = 8 * len(PARTS)
        for (name, kind), n in zip(PARTS, np.frombuffer(view, np.int64, len(PARTS)), strict=True):
            setattr(self, name, np.frombuffer(view, kind, int(n), at))
            at += int(n) * np.dtype(kind).itemsize

    def find(self, buf: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word of a buffer of bytes, -1 where the lexicon lacks it."""
        state, number = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        live, depth = np.arange(len(at)), 0
        while len(self.edges):
            live = live[sizes[live] > depth]
            if not len(live):
                break
            key = state[live] * 256 + buf[at[live] + depth]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            ok = self.edges[edge] == key
            state[live[~ok]] = -1
            live, edge = live[ok], edge[ok]
            number[live] += self.skips[edge]
            state[live] = self.targets[edge]
            depth += 1
        found = (state >= 0) & (sizes > 0)
        found[found] = self.accepts[state[found]] == 1
        return np.where(found, number, -1)

    def output(self, number: int) -> tuple[int, ...]:
        return tuple(self.ids[self.starts[number] : self.starts[number + 1]].tolist())
