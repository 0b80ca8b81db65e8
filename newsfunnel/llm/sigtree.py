"""Signature trees over token sets: OR-combined bitmaps and size ranges.

A set's signature is a bitmap with one bit for each of its tokens, about as
wide as the set is large (a power of two; a wide bitmap folds to a narrower
one).  An inner node holds the OR of its sets' bitmaps, their size range, and
the most tokens that share a bit with another token of their set.  Two sets
below two nodes can have at most

    popcount(OR_a & OR_b) + min(shared_a, shared_b)

common tokens, so a pair of nodes whose bound is below the overlap that the
smallest sizes demand holds no linked pair.  Both sides are descended at once.
"""

from __future__ import annotations

import numpy as np

FANOUT = 4


def width_of(n: int) -> int:
    return max(64, 1 << (max(n, 1) - 1).bit_length())


def signature(tokens: np.ndarray) -> bytes:
    """Bitmap of a set of 64-bit tokens."""
    bits = np.zeros(width_of(len(tokens)), bool)
    bits[(tokens >> np.uint64(20) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Node:
    """A set (``item`` >= 0) or several nodes."""

    __slots__ = ("item", "kids", "low", "high", "forms", "width", "size")

    def __init__(self, item: int, size: int, sig: bytes):
        self.item, self.kids, self.low, self.high, self.size = item, (), size, size, 1
        self.width = 8 * len(sig)
        bits = int.from_bytes(sig, "little")
        self.forms = {self.width: (bits, size - bits.bit_count())}

    @classmethod
    def summary(cls, item: int, low: int, high: int, sig: bytes, shared: int) -> Node:
        """Stands for several sets whose OR is ``sig``; a leaf of the tree that is built over such."""
        self = cls(item, high, sig)
        self.low = low
        self.forms = {self.width: (self.forms[self.width][0], shared)}
        return self

    @classmethod
    def over(cls, kids: list[Node]) -> Node:
        self = cls.__new__(cls)
        self.item, self.kids = -1, kids
        self.low, self.high = min(k.low for k in kids), max(k.high for k in kids)
        self.size = sum(k.size for k in kids)
        self.width, self.forms = min(k.width for k in kids), {}
        return self

    def at(self, width: int) -> tuple[int, int]:
        """(bitmap, most shared tokens) at a width that is not above the node's own."""
        form = self.forms.get(width)
        if form is None:
            if self.kids:
                bits = shared = 0
                for k in self.kids:
                    b, s = k.at(width)
                    bits |= b
                    shared = max(shared, s)
            else:
                (bits, shared), w = self.forms[self.width], self.width
                while w > width:
                    w >>= 1
                    left, right = bits & ((1 << w) - 1), bits >> w
                    # bits that meet; those of a summary's sets are among them
                    shared += (left & right).bit_count()
                    bits = left | right
                shared = min(shared, self.high)
            form = self.forms[width] = bits, shared
        return form

    def items(self):
        if self.item >= 0:
            yield self.item
        for k in self.kids:
            yield from k.items()


def build(leaves: list[Node]) -> Node:
    """Tree over leaves in the order of their size."""
    level = sorted(leaves, key=lambda x: x.low)
    while len(level) > 1:
        level = [Node.over(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
    return level[0]


def summaries(leaves: list[Node], groups: Groups) -> list[tuple[int, int, int, bytes, int]]:
    """(first leaf, low, high, OR bitmap, most shared tokens) of each group of leaves."""
    by: dict[int, list[Node]] = {}
    for x in leaves:
        by.setdefault(groups.find(x.item), []).append(x)
    out = []
    for first, some in by.items():
        node = Node.over(some)
        bits, shared = node.at(node.width)
        out.append((first, node.low, node.high, bits.to_bytes(node.width // 8, "little"), shared))
    return out


def possible(a: Node, b: Node, percent: int) -> bool:
    """Can a set below ``a`` and one below ``b`` have that Jaccard similarity?"""
    if 100 * a.high < percent * b.low or 100 * b.high < percent * a.low:
        return False
    # 100 * common >= percent * union, union = sizes - common, and union >= either size
    need = max(-(-percent * (a.low + b.low) // (100 + percent)), -(-percent * max(a.low, b.low) // 100))
    width = min(a.width, b.width)
    (x, s), (y, t) = a.at(width), b.at(width)
    return (x & y).bit_count() + min(s, t) >= need


class Groups:
    """Union-find over the sets of one tree."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def one(self, node: Node) -> int:
        """The group that all sets of a node are in, or -1."""
        got = -1
        for i in node.items():
            r = self.find(i)
            if got < 0:
                got = r
            elif r != got:
                return -1
        return got


def spanning_links(root: Node, n: int, percent: int, linked, groups: Groups | None = None) -> list[tuple[int, int]]:
    """Links that connect all sets which ``linked(i, j)`` pairs connect, beyond those
    that ``groups`` holds already.

    Dual traversal from (root, root).  Node pairs that cannot hold a link are
    pruned, and so are those whose sets are in one group already: a further
    link between them would connect nothing.
    """
    groups = groups or Groups(n)
    out: list[tuple[int, int]] = []
    stack = [(root, root)]
    while stack:
        a, b = stack.pop()
        if a is not b and not possible(a, b, percent):
            continue
        if a.item >= 0 and b.item >= 0:
            if a is not b and groups.find(a.item) != groups.find(b.item) and linked(a.item, b.item):
                groups.join(a.item, b.item)
                out.append((a.item, b.item))
            continue
        if n > 2 * FANOUT:
            one = groups.one(a)
            if one >= 0 and (a is b or one == groups.one(b)):
                continue
        if a is b:
            kids = a.kids
            # pairs apart first on the stack: those inside a child are taken up before them
            stack.extend((x, y) for i, x in enumerate(kids) for y in kids[i + 1:])
            stack.extend((x, x) for x in kids if x.kids)
        elif a.item >= 0 or b.item < 0 and b.size > a.size:
            stack.extend((a, y) for y in b.kids)
        else:
            stack.extend((x, b) for x in a.kids)
    return out
