"""Cheapest repair of role sequences, solved once per node of a suffix-shared automaton.

A signature has one letter per row: the role (`s`, `u`, `a` or `x` for any other; in
capitals if the text is truncated), or `d` for a row that has to go. Signatures that end
alike share their nodes: a node stands for a suffix, its edge leads to the suffix without
the first letter. Every node has, for each state of the grammar `(s?(ua)+)?`, the cost to
go and the place of its best audit among those of the four states.

What a node's edge has to decide depends on its letter and on the costs and places of the
node behind, so nodes that agree in both share one solved edge (the minimised automaton);
costs count from the cheapest state, the node adds its own base.
"""

from __future__ import annotations

from typing import NamedTuple

# states: nothing yet, after a system row, after a user row, after an assistant row
ROLE_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
NEVER = 10**15
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # fixed values


class Edge(NamedTuple):
    base: int  # what this edge adds to the cost of the cheapest state
    cost: tuple[int, ...]  # of each state, from the cheapest
    place: tuple[int, ...]  # of each state's audit in ASCII order; equal audits, equal place
    edits: tuple[str, ...]  # of each state: inserts, then what becomes of the row
    then: tuple[int, ...]  # state in which the rest of the rows is met


def _ranked(found: list[tuple[int, tuple]]) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    least = min(cost for cost, _ in found)
    order = sorted({audit for _, audit in found})
    return (
        least,
        tuple(cost - least for cost, _ in found),
        tuple(order.index(audit) for _, audit in found),
    )


def _inserts(state: int) -> list[tuple[int, str, int]]:
    """Cost, edits and state after the inserts that can pay before a row or the end."""
    steps, out = [(0, "", state)], []
    while steps:
        cost, edits, at = steps.pop()
        out.append((cost, edits, at))
        if len(edits) < 2:
            for role, after in ROLE_AFTER[at].items():
                if role != "s":
                    steps.append((cost + INSERT, edits + "I", after))
    return out


INSERTS = tuple(_inserts(state) for state in range(4))


def end_edge() -> Edge:
    """The end of a conversation: inserts alone lead to a final state."""
    found, edits = [], []
    for state in range(4):
        cost, text, _ = min(x for x in INSERTS[state] if x[2] in FINAL)
        found.append((cost, (text,)))
        edits.append(text)
    return Edge(*_ranked(found), tuple(edits), (0, 0, 0, 0))


def solved(letter: str, behind: Edge) -> Edge:
    """The edge of `letter` in front of a node with these costs and places.

    An audit is inserts, one edit and the audit behind; no such beginning is the start
    of another, so beginnings decide, then places.
    """
    role, more = letter.lower(), TRUNCATED * letter.isupper()
    found, edits, then = [], [], []
    for state in range(4):
        options = []
        for cost, text, at in INSERTS[state]:
            steps = [(cost + DELETE, "D", at)]
            if role != "d":
                if role in ROLE_AFTER[at]:
                    steps.append((cost + more, "K", ROLE_AFTER[at][role]))
                for other in "ua":
                    if other in ROLE_AFTER[at]:
                        steps.append((cost + more + REROLE, "R", ROLE_AFTER[at][other]))
            for paid, edit, after in steps:
                options.append((paid + behind.cost[after], (text + edit, behind.place[after]), after))
        cost, audit, after = min(options)
        found.append((cost, audit))
        edits.append(audit[0])
        then.append(after)
    return Edge(*_ranked(found), tuple(edits), tuple(then))


class Automaton:
    """Nodes of the suffixes of signatures that are added in order of their ends."""

    def __init__(self):
        self.edges: dict[tuple, Edge] = {}
        end = end_edge()
        # the path of the signature before: its nodes from the end, with their whole base
        self.path, self.bases, self.letters = [end], [end.base], ""
        self.nodes = 0

    def _edge(self, letter: str, behind: Edge) -> Edge:
        key = (letter, behind.cost, behind.place)
        if key not in self.edges:
            self.edges[key] = solved(letter, behind)
        return self.edges[key]

    def repair(self, signature: str) -> tuple[int, str]:
        """Cost and audit of the cheapest repair; only nodes that are new are solved."""
        backwards = signature[::-1]
        shared = _common(backwards, self.letters)
        del self.path[shared + 1 :], self.bases[shared + 1 :]
        for letter in backwards[shared:]:
            edge = self._edge(letter, self.path[-1])
            self.path.append(edge)
            self.bases.append(self.bases[-1] + edge.base)
            self.nodes += 1
        self.letters = backwards
        state, edits = 0, []
        for edge in reversed(self.path):
            edits.append(edge.edits[state])
            state = edge.then[state]
        return self.bases[-1] + self.path[-1].cost[0], "".join(edits)


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low
