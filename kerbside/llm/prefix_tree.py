"""A trie of ordered sets, searched for sets of a given Jaccard similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def needed(size: np.ndarray | int, other: np.ndarray | int, percent: int) -> np.ndarray:
    """The least overlap with which two sets of these sizes are similar."""
    return -(-percent * (np.asarray(size) + other) // (100 + percent))


class PrefixTree:
    """Sets as paths of a radix trie. One order holds for all: elements most frequent here come
    first, so that similar sets share long paths, and overlaps along them are counted once.

    Nodes lie in levels; a level is searched at once.
    """

    def __init__(self, sets: list[np.ndarray]):
        everything = np.concatenate(sets)
        elements, place, counts = np.unique(everything, return_inverse=True, return_counts=True)
        rank = np.empty(len(elements), dtype=np.int64)
        rank[np.lexsort((elements, -counts))] = np.arange(len(elements))
        parts = np.split(rank[place], np.cumsum([len(s) for s in sets])[:-1])
        self.paths = [np.sort(part) for part in parts]
        self.n_elements = len(elements)
        self.sizes = np.array([len(s) for s in sets])
        self._build()

    def _build(self) -> None:
        order = sorted(range(len(self.paths)), key=lambda i: self.paths[i].astype(">u4").tobytes())
        self.order = np.array(order)
        # A node: [parent, depth, first and end of the sets below it]; the root is node 0.
        nodes = [[-1, 0, 0, len(order)]]
        stack, ends_at, before = [0], np.zeros(len(order), dtype=np.int64), None
        for i, number in enumerate(order):
            path = self.paths[number]
            common = 0
            if before is not None:
                n = min(len(before), len(path))
                differs = np.flatnonzero(before[:n] != path[:n])
                common = int(differs[0]) if len(differs) else n
            child = None
            while nodes[stack[-1]][1] > common:
                child = stack.pop()
                nodes[child][3] = i
            if nodes[stack[-1]][1] < common:  # the path of ``child`` branches off within its last node
                nodes.append([nodes[child][0], common, nodes[child][2], i])
                nodes[child][0] = len(nodes) - 1
                stack.append(len(nodes) - 1)
            if len(path) > nodes[stack[-1]][1]:
                nodes.append([stack[-1], len(path), i, len(order)])
                stack.append(len(nodes) - 1)
            ends_at[i] = stack[-1]
            before = path
        for node in stack:
            nodes[node][3] = len(order)
        self._lay_out(np.array(nodes), ends_at)

    def _lay_out(self, nodes: np.ndarray, ends_at: np.ndarray) -> None:
        """Levels of nodes with what a search needs of each."""
        parent, depth, first, end = nodes.T
        sizes = self.sizes[self.order]
        ending = np.full(len(nodes), -1)
        ending[ends_at] = np.arange(len(ends_at))
        spans = np.column_stack([first, end]).ravel()
        padded = np.append(sizes, 0)
        least, most = np.minimum.reduceat(padded, spans)[::2], np.maximum.reduceat(padded, spans)[::2]
        self.levels = []
        row = np.zeros(len(nodes), dtype=np.int64)
        current = np.array([0])
        children = np.argsort(parent, kind="stable")
        from_, to = np.searchsorted(parent[children], [np.arange(len(nodes)), np.arange(len(nodes)) + 1])
        while len(current):
            row[current] = np.arange(len(current))
            segments = [
                self.paths[self.order[first[node]]][depth[parent[node]] if node else 0 : depth[node]] for node in current
            ]
            lengths = np.array([len(s) for s in segments])
            flat = np.concatenate(segments) if len(segments) else np.zeros(0, np.int64)
            self.levels.append(
                (
                    row[parent[current]], depth[current], lengths, np.cumsum(lengths) - lengths, flat,
                    np.array([s[-1] if len(s) else -1 for s in segments]), least[current], most[current],
                    ending[current], np.column_stack([first[current], end[current]]).ravel(),
                )
            )
            current = np.concatenate([children[from_[n] : to[n]] for n in current])

    def search(self, number: int, percent: int, low: np.ndarray, high: np.ndarray, label: int) -> np.ndarray:
        """Sets similar to set ``number``, by their place in ``order``.

        ``low`` and ``high`` are labels of the sets in that order; subtrees where all have
        ``label`` are left out.
        """
        path = self.paths[number]
        mark = np.zeros(self.n_elements, dtype=np.int64)
        mark[path] = 1
        passed = np.append(np.cumsum(mark), 0)  # at -1: nothing passed yet
        size, found = len(path), []
        overlap, alive = np.zeros(1, dtype=np.int64), np.ones(1, dtype=bool)
        for above, depth, lengths, starts, flat, last, least, most, ending, spans in self.levels:
            rows = np.flatnonzero(alive[above])
            if not len(rows):
                break
            n = lengths[rows]
            # Overlap of each node's part of the path, on top of its parent's.
            index = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            sums = np.concatenate([[0], np.cumsum(mark[flat[index]])])
            ends = np.cumsum(n)
            shared = overlap[above[rows]] + sums[ends] - sums[ends - n]
            left = size - passed[last[rows]]
            # The set size below this node with the best chance, and the overlap it could reach.
            best = np.clip(depth[rows] + left, least[rows], most[rows])
            reach = shared + np.minimum(left, best - depth[rows])
            ok = reach >= needed(size, best, percent)
            pairs = np.column_stack([spans[2 * rows], spans[2 * rows + 1]]).ravel()
            ok &= (np.minimum.reduceat(low, pairs)[::2] < label) | (np.maximum.reduceat(high, pairs)[::2] > label)
            rows, shared = rows[ok], shared[ok]
            here = ending[rows]
            similar = (here >= 0) & (shared >= needed(size, self.sizes[self.order[here]], percent))
            found.append(here[similar])
            overlap, alive = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=bool)
            overlap[rows], alive[rows] = shared, True
        return np.concatenate(found)


def links(sets: list[np.ndarray], groups: list[int], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of similar sets that connect all groups which similar sets connect.

    Sets of one group are known to be connected. Each set is compared with those it is not
    connected with yet, except that sets of the largest group only wait for the others.
    """
    tree = PrefixTree(sets)
    label = np.unique(groups, return_inverse=True)[1][tree.order] + 1
    waiting = np.bincount(label).argmax()
    # Beyond the labels on either side: sets that every other has been compared with.
    low, high = np.append(label, 1 << 60), np.append(label, -1)
    for at in range(len(sets)):
        number = tree.order[at]
        if label[at] == waiting and np.bincount(label).max() > 1:
            continue
        own = label[at]
        for other in tree.search(number, percent, low, high, own):
            if label[other] != label[at]:
                yield int(number), int(tree.order[other])
                gone, stays = sorted((label[at], label[other]), reverse=True)
                for labels in (label, low, high):
                    labels[labels == gone] = stays
                waiting = stays if gone == waiting else waiting
        low[at], high[at] = 1 << 60, -1
