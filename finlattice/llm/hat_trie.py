"""Counting of word-id paths in a HAT-trie: a shallow trie over word ids above burstable hash containers.

A path is a row of ids, kept as bytes (big-endian, so that their order is the paths'). A node parts the ids at its depth into ranges, each with a hash
container of the rest of the paths; a container that grows too large bursts, into two ranges or, if it is about one id only, into a node below. When all containers together hold too many
paths, whole subtrees leave as sorted runs, the largest first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np

#: Paths of a container, of the whole trie, and of a block put in at once.
BURST, LIMIT, BLOCK = 1 << 14, 1 << 20, 1 << 18


class Container:
    """Counts of the paths below a range of ids at ``depth``; ``known``: the bytes of the path above."""

    def __init__(self, depth: int, known: bytes, counts: Counter | None = None) -> None:
        self.depth, self.known, self.counts = depth, known, counts if counts is not None else Counter()

    def size(self) -> int:
        return len(self.counts)

    def add(self, paths: np.ndarray) -> None:
        width = 4 * (paths.shape[1] - self.depth)
        self.counts.update(np.ascontiguousarray(paths[:, self.depth :], ">u4").view(f"S{width}").ravel().tolist())

    def items(self) -> Iterator[tuple[bytes, int]]:
        for rest in sorted(self.counts):
            yield self.known + rest, self.counts[rest]

    def burst(self) -> tuple[list[int], list[Container | Node]]:
        """What takes its place: lower ends of the ranges (None: as before) and their kids."""
        keys = sorted(self.counts)
        head = lambda i: int.from_bytes(keys[i][:4].ljust(4, b"\0"), "big")
        first, last = head(0), head(-1)
        if first == last:
            below = Counter({k[4:]: self.counts[k] for k in keys})
            node = Node(self.depth + 1, [0], [Container(self.depth + 1, self.known + first.to_bytes(4, "big"), below)])
            # of equal lower ends only the last is used
            return [-1, first, first + 1], [Container(self.depth, self.known), node, Container(self.depth, self.known)]
        cut = head(len(keys) // 2)
        cut = cut if cut > first else cut + 1
        low = Counter({k: c for k, c in self.counts.items() if int.from_bytes(k[:4].ljust(4, b"\0"), "big") < cut})
        high = Counter({k: c for k, c in self.counts.items() if k not in low})
        return [-1, cut], [Container(self.depth, self.known, low), Container(self.depth, self.known, high)]


class Node:
    """Ranges of the ids at ``depth``, by their lower ends, and what is below each."""

    def __init__(self, depth: int, lows: list[int], kids: list[Container | Node]) -> None:
        self.depth, self.lows, self.kids = depth, lows, kids

    def size(self) -> int:
        return sum(k.size() for k in self.kids)

    def add(self, paths: np.ndarray) -> None:
        at = np.searchsorted(self.lows, paths[:, self.depth], "right") - 1
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for group in reversed(np.split(order, cuts)):  # from the last, as a burst moves those behind it
            i = int(at[group[0]])
            kid = self.kids[i]
            kid.add(paths[group])
            if isinstance(kid, Container):
                self._burst(i, paths.shape[1])

    def _burst(self, i: int, length: int) -> None:
        """Bursts a container until none of its heirs is too large; a last id alone can't be parted."""
        kid = self.kids[i]
        if isinstance(kid, Node):
            if len(kid.kids) == 1:
                kid._burst(0, length)
            return
        if kid.size() <= BURST:
            return
        lows, kids = kid.burst()
        self.lows[i + 1 : i + 1], self.kids[i : i + 1] = lows[1:], kids
        for j in range(i + len(kids) - 1, i - 1, -1):
            self._burst(j, length)

    def items(self) -> Iterator[tuple[bytes, int]]:
        for kid in self.kids:
            yield from kid.items()


class HatTrie:
    """Counts rows of ``length`` ids."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.root = Node(0, [0], [Container(0, b"")])

    def add(self, paths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Counts the rows of ``paths``; sorted runs that had to leave."""
        for i in range(0, len(paths), BLOCK):
            self.root.add(paths[i : i + BLOCK])
            if self.root.size() > LIMIT:
                yield self.spill(LIMIT // 2)

    def spill(self, keep: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Takes out whole subtrees, the largest first, until at most ``keep`` paths are left: their paths in order, and counts."""
        sizes = [k.size() for k in self.root.kids]
        left, out = sum(sizes), []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if left <= keep:
                break
            out.append(i)
            left -= sizes[i]
        paths, counts = [], []
        for i in sorted(out):
            for path, n in self.root.kids[i].items():
                paths.append(path)
                counts.append(n)
            self.root.kids[i] = Container(0, b"")
        flat = np.array(paths, f"S{4 * self.length}") if paths else np.zeros(0, f"S{4 * self.length}")
        return flat.view(">u4").reshape(-1, self.length).astype(np.int64), np.array(counts, np.int64)
