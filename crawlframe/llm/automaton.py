"""Rule regexes compiled into one minimal deterministic automaton over bytes.

Each rule becomes a Thompson automaton; their union, free to start anywhere, is determinised by
subset construction over byte classes and minimised by partition refinement. The result is a
transition array; a state's mask says which rules have a match ending there.

``scan`` runs the array over a whole batch in lanes: a byte that leads every state back to the
start cuts the batch into independent segments, lanes are runs of segments of about equal length,
and one array step moves all lanes on by a byte. Each byte is looked at once for all rules.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser

import numpy as np


class _Builder:
    """Thompson construction from the standard library's parse tree: literals, classes, groups, branches, repeats."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.on: list[list[tuple[np.ndarray, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.on.append([])
        return len(self.empty) - 1

    def add(self, tree, at: int, fold: bool) -> int:
        for kind, value in tree:
            at = self.node(kind, value, at, fold)
        return at

    def node(self, kind, value, at: int, fold: bool) -> int:
        if kind in (op.LITERAL, op.NOT_LITERAL, op.IN, op.ANY):
            end = self.state()
            self.on[at].append((_bytes(kind, value, fold), end))
            return end
        if kind is op.SUBPATTERN:
            _, add, _, tree = value
            return self.add(tree, at, fold or bool(add & 2))
        if kind is op.BRANCH:
            end = self.state()
            for tree in value[1]:
                start = self.state()
                self.empty[at].append(start)
                self.empty[self.add(tree, start, fold)].append(end)
            return end
        if kind in (op.MAX_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, tree = value
            for _ in range(low):
                at = self.add(tree, at, fold)
            if high is op.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(tree, loop, fold)].append(loop)
                return loop
            end = self.state()
            for _ in range(high - low):
                self.empty[at].append(end)
                at = self.add(tree, at, fold)
            self.empty[at].append(end)
            return end
        raise ValueError(f"rules cannot use {kind}")


def _bytes(kind, value, fold: bool) -> np.ndarray:
    """The set of bytes a one-byte node takes."""
    out = np.zeros(256, bool)
    if kind is op.ANY:
        out[:] = True
        out[10] = False
    elif kind is op.IN:
        for k, v in value:
            if k is op.LITERAL:
                out[v] = True
            elif k is op.RANGE:
                out[v[0] : v[1] + 1] = True
            elif k is not op.NEGATE:
                raise ValueError(f"rules cannot use {k}")
        if value[0][0] is op.NEGATE:
            out = ~out
    else:
        out[value] = True
        out = ~out if kind is op.NOT_LITERAL else out
    if fold:
        out[65:91] |= out[97:123]
        out[97:123] |= out[65:91]
    return out


class Automaton:
    """``table[state, byte]`` is the next state; ``masks[state]`` the rules that end there; 0 is the start."""

    def __init__(self, rules: list[bytes], anywhere: bool = True) -> None:
        build = _Builder()
        root, ends = build.state(), {}
        for k, rule in enumerate(rules):
            tree = _parser.parse(rule)
            start = build.state()
            build.empty[root].append(start)
            ends[build.add(tree, start, bool(tree.state.flags & 2))] = 1 << k
        sets = np.array([s for row in build.on for s, _ in row], bool)
        _, first, self.kind = np.unique(sets, axis=1, return_index=True, return_inverse=True)
        self.kind = self.kind.reshape(-1)
        self._determinise(build, root, ends, first, anywhere)
        self._minimise()
        self.table = np.ascontiguousarray(self.steps[:, self.kind])
        self.resets = (self.table == 0).all(axis=0)
        stuck = np.flatnonzero((self.steps == np.arange(len(self.steps))[:, None]).all(axis=1) & (self.masks == 0))
        #: The state without a way out, if there is one.
        self.dead = int(stuck[0]) if len(stuck) else -1
        #: States whose number is at least this end some rule.
        self.accepting = int((self.masks == 0).sum())

    def _determinise(self, build: _Builder, root: int, ends: dict[int, int], probes: np.ndarray, anywhere: bool) -> None:
        def closure(states: set[int]) -> frozenset[int]:
            todo, seen = list(states), set(states)
            while todo:
                for nxt in build.empty[todo.pop()]:
                    if nxt not in seen:
                        seen.add(nxt)
                        todo.append(nxt)
            return frozenset(s for s in seen if build.on[s] or s in ends)

        moves: dict[tuple[int, int], frozenset[int]] = {}

        def move(state: int, kind: int) -> frozenset[int]:
            if (state, kind) not in moves:
                moves[state, kind] = closure({t for s, t in build.on[state] if s[probes[kind]]})
            return moves[state, kind]

        start = closure({root})
        again = start if anywhere else frozenset()
        number, todo, steps = {start: 0}, [start], []
        for here in todo:
            row = []
            for kind in range(len(probes)):
                there = frozenset(again.union(*(move(s, kind) for s in here)))
                if there not in number:
                    number[there] = len(todo)
                    todo.append(there)
                row.append(number[there])
            steps.append(row)
        self.steps = np.array(steps, np.int32)
        self.masks = np.array([sum({ends[s] for s in here if s in ends}) for here in todo], np.int64)

    def _minimise(self) -> None:
        _, part = np.unique(self.masks, return_inverse=True)
        count = 0
        while part.max() + 1 != count:
            count = part.max() + 1
            _, part = np.unique(np.column_stack([part, part[self.steps]]), axis=0, return_inverse=True)
            part = part.reshape(-1)
        _, keep = np.unique(part, return_index=True)
        # The start first, then states that end nothing, then the others.
        keep = keep[np.lexsort((keep, self.masks[keep] != 0))]
        keep = np.concatenate([keep[part[keep] == part[0]], keep[part[keep] != part[0]]])
        new = np.empty(count, np.int32)
        new[part[keep]] = np.arange(count)
        self.masks, self.steps = self.masks[keep], new[part[self.steps[keep]]]

    def scan(self, data: np.ndarray, lanes: int = 8192) -> tuple[np.ndarray, np.ndarray]:
        """Positions after the bytes at which some rule ends, in order, and the rules' masks there."""
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cuts = np.flatnonzero(self.resets[data]) + 1
        ideal = np.arange(0, len(data), max(64, len(data) // lanes + 1))
        spot = np.searchsorted(cuts, ideal[1:])
        starts = np.unique(np.concatenate([[0], cuts[spot[spot < len(cuts)]]]))
        starts = starts[starts < len(data)]
        lengths = np.diff(np.append(starts, len(data)))
        order = np.argsort(-lengths, kind="stable")
        at, left = starts[order].astype(np.int64), -lengths[order]
        flat, state = self.table.reshape(-1), np.zeros(len(at), np.int64)
        ends, masks = [], []
        for step in range(int(lengths.max())):
            alive = int(np.searchsorted(left, -step))
            if alive < len(state):
                state, at = state[:alive], at[:alive]
            state = flat[(state << 8) + data[at]].astype(np.int64)
            at = at + 1
            if (hit := state >= self.accepting).any():
                ends.append(at[hit])
                masks.append(self.masks[state[hit]])
        if not ends:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends, masks = np.concatenate(ends), np.concatenate(masks)
        order = np.argsort(ends, kind="stable")
        return ends[order], masks[order]

    def longest(self, data: bytes, start: int, stop: int) -> int:
        """End of the longest match that begins at ``start`` (an automaton not free to start anywhere), or -1."""
        state, end = 0, -1
        table, masks, dead = self.table, self.masks, self.dead
        for i in range(start, stop):
            state = table[state, data[i]]
            if state == dead:
                break
            if masks[state]:
                end = i + 1
        return end
