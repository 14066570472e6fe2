"""Signature trees: exact joins of token sets by dual traversal.

A leaf holds a few sets of similar size and signature. A node holds the OR of its sets'
bitmaps, the range of their sizes, and how many tokens a bitmap may hide. Two nodes are
compared only if the largest overlap that any of their sets could have still reaches what
the smaller size of the larger side demands, and if not all their sets are linked already.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LEAF, FAN = 8, 4


def needed(size: int, percent: int) -> int:
    """The least overlap with which a set of ``size`` tokens can reach ``percent`` similarity."""
    return -(-percent * size // 100)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


@dataclass
class Node:
    bits: np.ndarray
    low: int
    high: int
    hidden: int
    members: list[int]
    children: list[Node]


class Linked:
    """Union-find over positions, begun from known labels; the smallest position leads."""

    def __init__(self, labels: list[int]):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(label, k) for k, label in enumerate(labels)]

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


class SignatureTree:
    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        sizes = np.array([len(s) for s in sets])
        width = 1 << max(6, int(4 * sizes.max(initial=1)).bit_length())
        self.bits = np.zeros((len(sets), width // 64), np.uint64)
        for k, s in enumerate(sets):
            at = s % np.uint64(width)
            np.bitwise_or.at(self.bits[k], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.hidden = sizes - np.bitwise_count(self.bits).sum(1).astype(np.int64)
        # Sets alike in size and smallest tokens lie together.
        order = sorted(range(len(sets)), key=lambda k: (len(sets[k]).bit_length(), sets[k][:4].tolist(), len(sets[k])))
        level = [self.node(order[k : k + LEAF], []) for k in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [self.node([m for c in level[k : k + FAN] for m in c.members], level[k : k + FAN]) for k in range(0, len(level), FAN)]
        self.root = level[0] if level else None

    def node(self, members: list[int], children: list[Node]) -> Node:
        sizes = [len(self.sets[m]) for m in members]
        bits = np.bitwise_or.reduce([c.bits for c in children] if children else self.bits[members])
        return Node(bits, min(sizes), max(sizes), int(self.hidden[members].max()), members, children)

    def may_link(self, a: Node, b: Node) -> bool:
        shared = int(np.bitwise_count(a.bits & b.bits).sum())
        return min(a.high, b.high, shared + min(a.hidden, b.hidden)) >= needed(max(a.low, b.low), self.percent)

    def links(self, linked: Linked) -> Iterator[tuple[int, int]]:
        """Links found by traversal of the tree against itself, short of those that ``linked`` already implies."""
        if self.root is None:
            return
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            roots = {linked.find(m) for m in a.members}
            if len(roots) == 1 and (a is b or all(linked.find(m) in roots for m in b.members)):
                continue
            if a is not b and not self.may_link(a, b):
                continue
            if a.children and b.children:
                # Popped from the end: a child against itself comes before it meets the others.
                pairs = [(x, y) for i, x in enumerate(a.children) for y in (b.children[i:] if a is b else b.children)]
                todo += sorted(pairs, key=lambda p: p[0] is p[1])
            elif a.children or b.children:
                whole, parts = (b, a.children) if a.children else (a, b.children)
                todo += [(part, whole) for part in parts]
            else:
                yield from self.compare(a, b, linked)

    def compare(self, a: Node, b: Node, linked: Linked) -> Iterator[tuple[int, int]]:
        for i, x in enumerate(a.members):
            others = a.members[i + 1 :] if a is b else b.members
            for y in others:
                if linked.find(x) != linked.find(y):
                    m, n = len(self.sets[x]), len(self.sets[y])
                    shared = int(np.bitwise_count(self.bits[x] & self.bits[y]).sum())
                    if min(m, n, shared + min(self.hidden[x], self.hidden[y])) >= needed(max(m, n), self.percent) and similar(self.sets[x], self.sets[y], self.percent):
                        linked.join(x, y)
                        yield x, y


def link(sets: list[np.ndarray], labels: list[int], percent: int) -> list[int]:
    """For each set, the label of the smallest position it is linked with, directly or through others."""
    linked = Linked(labels)
    for _ in SignatureTree(sets, percent).links(linked):
        pass
    return [labels[linked.find(k)] for k in range(len(sets))]
