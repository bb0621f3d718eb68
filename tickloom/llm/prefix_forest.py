"""Prefix tries of sorted sequences by union-find over the links between neighbours.

Sequences of one range stand in order. Neighbours are linked at the depth of their common
prefix; links are taken from the deepest on, and every one that joins two components makes
(or widens) the branching node at its depth. Between branching nodes lie chains with one
child each.

A range sees only its own sequences. A node that it shares with the range before or after
(a prefix of its first or last sequence, no deeper than what they have in common with
their outer neighbours) stays open: it is handed on with what the range knows of it.
`merge` contracts the open nodes of neighbouring ranges in the same way.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

WIDTH = 16  # bytes a turn in a key


class Sequence(NamedTuple):
    group: bytes  # sequences of different groups share no node
    key: bytes  # `WIDTH` bytes a turn
    words: list[int]  # a turn
    n: int  # conversations
    conv: int  # the smallest of them
    ends: str | None  # hash of those that end here
    head: int | None  # the smallest of those at the group's root, if that is no root of all
    n_children: int  # below, in a later group
    n_leaves: int
    saved: int


class Node(NamedTuple):
    group: bytes
    depth: int
    id: bytes | None  # only nodes that other ranges know have one
    parent_id: bytes | None  # set where the parent is still open
    parent: int | None
    conv: int
    n: int
    n_children: int  # of open nodes: closed ones only; likewise the next two
    n_leaves: int
    saved: int
    ends: str | None
    words: int
    left: bool  # shared with the range before
    right: bool


class Top:
    """The highest node so far of a component, and the children that wait for its smallest member."""

    __slots__ = ("depth", "at", "n", "conv", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, at: int, s: Sequence):
        self.depth, self.at = len(s.key) // WIDTH, at
        self.n, self.conv, self.ends = s.n, s.conv, s.ends
        self.children, self.leaves, self.saved = s.n_children, s.n_leaves, s.saved
        self.waiting: list[int] = []

    def join(self, other: Top) -> None:
        """Both stand at the same depth of the same path."""
        self.n += other.n
        self.conv = min(self.conv, other.conv)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends or other.ends
        if len(self.waiting) < len(other.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting


def common(a: Sequence, b: Sequence) -> int:
    """Turns of the common prefix; -1 across groups."""
    return common_turns(a.group, a.key, b.group, b.key)


def common_turns(group: bytes, key: bytes, other_group: bytes, other: bytes) -> int:
    if group != other_group:
        return -1
    low, high = 0, min(len(key), len(other)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if key[: middle * WIDTH] == other[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def node_id(group: bytes, prefix: bytes) -> bytes:
    return hashlib.sha256(group + prefix).digest()[:16]


def _ids(s: Sequence, depth: int) -> list[bytes]:
    """Of the nodes on the way down to `depth`."""
    running, out = hashlib.sha256(s.group), []
    for d in range(depth + 1):
        out.append(running.copy().digest()[:16])
        running.update(s.key[d * WIDTH : (d + 1) * WIDTH])
    return out


def forest(sequences: list[Sequence], left: int, right: int) -> list[Node]:
    """All nodes of a range; `left` and `right` are the depths shared with its neighbours, or -1."""
    last = len(sequences) - 1
    links = [(common(sequences[i], sequences[i + 1]), i) for i in range(last)]
    tops = [Top(i, s) for i, s in enumerate(sequences)]
    root = list(range(last + 1))
    lowest, highest = root[:], root[:]  # sequences of a component
    out: list[list] = []
    ids = {0: _ids(sequences[0], left), last: _ids(sequences[last], right)} if sequences else {}
    if last == 0:
        ids[0] = _ids(sequences[0], max(left, right))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def rise(i: int, to: int) -> None:
        """Emit the component's nodes above `to`, so that it stands there."""
        top = tops[i]
        s = sequences[top.at]
        first, final = lowest[i] == 0, highest[i] == last
        while top.depth > to:
            d = top.depth
            on_left, on_right = first and d <= left, final and d <= right
            is_open = on_left or on_right
            conv = s.head if d == 0 and s.head is not None else top.conv
            words = s.words[d - 1] if d else 0
            path = ids[0 if on_left else last] if is_open else None
            for child in top.waiting:
                out[child][3 if is_open else 4] = path[d] if is_open else conv
            saved = top.saved + (0 if is_open else (top.n - 1) * words)
            leaves = top.leaves if top.children or is_open else 1
            out.append(
                [s.group, d, path[d] if is_open else None, path[d - 1] if is_open and d else None, None]
                + [conv, top.n, top.children, leaves, saved, top.ends, words, on_left, on_right]
            )
            top.waiting = [] if is_open else [len(out) - 1]
            top.children, top.leaves, top.saved = (0, 0, 0) if is_open else (1, leaves, saved)
            top.depth, top.ends = d - 1, None

    for depth, i in sorted(links, key=lambda x: -x[0]):
        if depth < 0:
            break
        a, b = find(i), find(i + 1)
        rise(a, depth)
        rise(b, depth)
        tops[a].join(tops[b])
        root[b] = a
        highest[a] = highest[b]
        tops[b] = None
    for i, top in enumerate(tops):
        if top is not None:
            rise(i, -1)
    return [Node(*x) for x in out]


class Merged:
    """What several ranges know of one open node."""

    __slots__ = ("node", "conv", "n", "children", "leaves", "saved", "ends", "left", "right")

    def __init__(self, node: Node):
        self.node, self.conv, self.ends = node, node.conv, None
        self.n = self.children = self.leaves = self.saved = 0
        self.left = self.right = False

    def add(self, x: Node, first: bool, last: bool) -> None:
        self.conv = min(self.conv, x.conv)
        self.n += x.n
        self.children += x.n_children
        self.leaves += x.n_leaves
        self.saved += x.saved
        self.ends = self.ends or x.ends
        self.left |= first and x.left
        self.right |= last and x.right

    @property
    def open(self) -> bool:
        return self.left or self.right


def merge(nodes: list[tuple[Node, bool, bool]]) -> list[Node]:
    """Open nodes of neighbouring ranges as one range.

    Each comes with whether its range is the first and the last of them. A node stays open
    where the merged range shares it with its neighbours. Open nodes are shared by two
    sequences at least, so each has children when it closes.
    """
    known: dict[bytes, Merged] = {}
    for x, first, last in nodes:
        known.setdefault(x.id, Merged(x)).add(x, first, last)
    deepest_first = sorted(known.values(), key=lambda m: -m.node.depth)
    for m in deepest_first:
        if m.open:
            continue
        m.saved += (m.n - 1) * m.node.words
        above = known.get(m.node.parent_id)
        if above:
            above.children += 1
            above.leaves += m.leaves
            above.saved += m.saved
    out = []
    for m in deepest_first:
        x, above = m.node, known.get(m.node.parent_id)
        settled = above is not None and not above.open and not m.open
        out.append(
            x._replace(
                parent_id=None if settled else x.parent_id,
                parent=above.conv if settled else None,
                conv=m.conv,
                n=m.n,
                n_children=m.children,
                n_leaves=m.leaves,
                saved=m.saved,
                ends=m.ends,
                left=m.left,
                right=m.right,
            )
        )
    return out
