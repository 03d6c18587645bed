"""Minimal acyclic transducers: sorted words in, the number of each out.

States that accept the same endings are one state. Every edge carries how many words come before
those behind it, so the sum along a word's path is its place in the sorted list (Lucchesi and
Kowaltowski); states are merged while the sorted words are read (Daciuk and others).
"""

from __future__ import annotations

import struct

import numpy as np


class Transducer:
    """Edges sorted by state and byte: ``keys`` (state * 256 + byte), ``targets``, ``skips``."""

    def __init__(
        self, keys: np.ndarray, targets: np.ndarray, skips: np.ndarray, final: np.ndarray, root: int
    ) -> None:
        self.keys, self.targets, self.skips = keys, targets, skips
        self.final, self.root = final, root

    @classmethod
    def build(cls, words: list[bytes]) -> "Transducer":
        """From distinct words in ascending order of bytes."""
        register: dict[tuple, int] = {}
        nodes: list[tuple] = []
        behind: list[int] = []
        path: list[list] = [[False, []]]  # final, edges so far
        letters: list[int] = []

        def close(depth: int) -> None:
            """Fix the states of the open path that lie deeper than ``depth``."""
            while len(path) > depth + 1:
                final, edges = path.pop()
                node = (final, tuple(edges))
                at = register.get(node)
                if at is None:
                    at = register[node] = len(nodes)
                    nodes.append(node)
                    behind.append(final + sum(behind[t] for _, t in edges))
                path[-1][1].append((letters.pop(), at))

        before: bytes | None = None
        for word in words:
            if before is not None and word <= before:
                raise ValueError("words must be distinct and sorted")
            shared = 0
            while before is not None and shared < min(len(before), len(word)) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            for letter in word[shared:]:
                letters.append(letter)
                path.append([False, []])
            path[-1][0] = True
            before = word
        close(0)
        root = len(nodes)
        nodes.append((path[0][0], tuple(path[0][1])))
        keys, targets, skips = [], [], []
        for at, (final, edges) in enumerate(nodes):
            skip = int(final)
            for letter, target in edges:
                keys.append(at << 8 | letter)
                targets.append(target)
                skips.append(skip)
                skip += behind[target]
        return cls(
            np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int32),
            np.array([n[0] for n in nodes], np.uint8), root,
        )

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqq", len(self.keys), len(self.final), self.root)
        parts = (self.keys, self.targets, self.skips, self.final)
        return head + b"".join(x.tobytes() for x in parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Transducer":
        edges, states, root = struct.unpack_from("<qqq", raw)
        at, parts = 24, []
        for kind, n in ((np.int64, edges), (np.int32, edges), (np.int32, edges), (np.uint8, states)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        return cls(*parts, root)

    def places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Place of each word ``data[start : start + length]``, -1 for words it does not hold.

        All words take their next step together.
        """
        out = np.zeros(len(starts), dtype=np.int64)
        state = np.full(len(starts), self.root, dtype=np.int64)
        alive = np.arange(len(starts))
        step = 0
        while True:
            ended = lengths[alive] == step
            done = alive[ended]
            out[done[self.final[state[done]] == 0]] = -1
            alive = alive[~ended]
            if not alive.size:
                return out
            if not len(self.keys):
                out[alive] = -1
                return out
            wanted = state[alive] << 8 | data[starts[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[edge] == wanted
            out[alive[~found]] = -1
            alive, edge = alive[found], edge[found]
            out[alive] += self.skips[edge]
            state[alive] = self.targets[edge]
            step += 1
