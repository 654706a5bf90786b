"""Weighted acyclic automata over words: the counts of n-grams, with equal states made once.

An automaton reads an n-gram word by word; the weight of the last arc is its count (0: only a longer one was
counted). It is built from sorted n-grams, level by level: the states of a level are the different prefixes, and from
the last level up those whose arcs agree in word, weight and target become one state. State 0 is the end, without arcs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_SIZES = np.dtype([("words", "<i8"), ("states", "<i8"), ("arcs", "<i8")])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


@dataclass
class Grams:
    """N-grams as rows of word numbers, -1 after the last; ``words`` are what the numbers stand for."""

    words: list[bytes]
    rows: np.ndarray
    counts: np.ndarray

    def restricted(self, at: np.ndarray) -> Grams:
        """The rows ``at``, with only their words, numbered in the same order."""
        rows = self.rows[at]
        used = np.unique(rows[rows >= 0])
        number = np.full(len(self.words) + 1, -1, np.int32)
        number[used] = np.arange(len(used))
        return Grams([self.words[i] for i in used], number[rows], self.counts[at])


def together(parts: list[Grams]) -> Grams:
    """All rows over one list of words, which is in the order of bytes; equal rows aren't summed yet."""
    words = sorted({w for p in parts for w in p.words})
    number = {w: i for i, w in enumerate(words)}
    width = max([p.rows.shape[1] for p in parts])
    rows = []
    for p in parts:
        names = np.array([*(number[w] for w in p.words), -1], np.int32)
        wide = np.full((len(p.rows), width), -1, np.int32)
        wide[:, : p.rows.shape[1]] = names[p.rows]
        rows.append(wide)
    return Grams(words, np.concatenate(rows), np.concatenate([p.counts for p in parts]))


@dataclass
class CountAutomaton:
    words: list[bytes]  # what the labels stand for, in the order of bytes
    first: np.ndarray  # the arcs of state s are those from first[s] to before first[s + 1]
    label: np.ndarray
    target: np.ndarray
    weight: np.ndarray

    @property
    def root(self) -> int:
        return len(self.first) - 2

    @classmethod
    def of(cls, grams: Grams) -> CountAutomaton:
        """The automaton of these n-grams in any order; counts of equal ones add up."""
        many = max(1, len(grams.words))
        levels, node = [], np.zeros(len(grams.rows), np.int64)
        live = np.arange(len(grams.rows))
        for depth in range(grams.rows.shape[1]):
            live = live[grams.rows[live, depth] >= 0]
            if not len(live):
                break
            arcs, node_of = np.unique(node[live] * many + grams.rows[live, depth], return_inverse=True)
            node[live] = node_of
            last = np.ones(len(live), bool)
            if depth + 1 < grams.rows.shape[1]:
                last = grams.rows[live, depth + 1] < 0
            weight = np.zeros(len(arcs), np.int64)
            np.add.at(weight, node_of[last], grams.counts[live[last]])
            levels.append((arcs // many, arcs % many, weight))
        return cls._minimal(grams.words, levels)

    @classmethod
    def _minimal(cls, words: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> CountAutomaton:
        sizes, labels, targets, weights = [np.zeros(1, np.int64)], [], [], []
        states = 1
        below = np.zeros(len(levels[-1][0]) if levels else 0, np.int64)  # the state that each arc of a level leads to
        for depth in range(len(levels) - 1, -1, -1):
            parent, label, weight = levels[depth]
            nodes, begins, lengths = np.unique(parent, return_index=True, return_counts=True)
            u = np.uint64
            arc = mixed(mixed(label.astype(u) * u(0x9E3779B97F4A7C15) + below.astype(u)) + weight.astype(u) * u(0xC2B2AE3D27D4EB4F))
            _, chosen, same = np.unique(np.add.reduceat(arc, begins) + lengths.astype(u), return_index=True, return_inverse=True)
            place = np.arange(len(parent)) - np.repeat(begins, lengths)
            twin = np.repeat(begins[chosen[same]], lengths) + place
            alike = np.array_equal(lengths, lengths[chosen[same]]) and all(np.array_equal(x, x[twin]) for x in (label, weight, below))
            if not alike:  # two states had one hash: keep every state of the level
                chosen, same = np.arange(len(nodes)), np.arange(len(nodes))
            kept = np.repeat(begins[chosen], lengths[chosen]) + _within(lengths[chosen])
            sizes.append(lengths[chosen])
            labels.append(label[kept])
            targets.append(below[kept])
            weights.append(weight[kept])
            # a node without arcs is the end
            below = np.zeros(len(levels[depth - 1][0]) if depth else 1, np.int64)
            below[nodes] = same + states
            states += len(chosen)
        if not levels:
            sizes.append(np.zeros(1, np.int64))
        first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        empty = np.zeros(0, np.int64)
        label, target, weight = (np.concatenate(x) if x else empty for x in (labels, targets, weights))
        return cls(words, first, label.astype(np.int32), target.astype(np.int32), weight)

    def paths(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """N-grams of 1, 2, ... words that were counted, sorted, and their counts."""
        state, rows = np.array([self.root]), np.zeros((1, 0), np.int32)
        while len(state):
            many = self.first[state + 1] - self.first[state]
            arc = np.repeat(self.first[state], many) + _within(many)
            rows = np.column_stack([np.repeat(rows, many, axis=0), self.label[arc]])
            counted = self.weight[arc] > 0
            yield rows[counted], self.weight[arc][counted]
            state = self.target[arc]
            rows, state = rows[state > 0], state[state > 0]

    def grams(self) -> Grams:
        found = [(r, c) for r, c in self.paths() if r.shape[1] and len(r)]
        width = max([r.shape[1] for r, _ in found], default=1)
        wide = [np.pad(r, ((0, 0), (0, width - r.shape[1])), constant_values=-1) for r, _ in found]
        if not wide:
            return Grams(self.words, np.zeros((0, 1), np.int64), np.zeros(0, np.int64))
        return Grams(self.words, np.concatenate(wide), np.concatenate([c for _, c in found]))

    @classmethod
    def union(cls, automata: list[CountAutomaton]) -> CountAutomaton:
        """All n-grams of the automata, weights summed."""
        return cls.of(together([a.grams() for a in automata])) if automata else cls.of(Grams([], np.zeros((0, 1), np.int64), np.zeros(0, np.int64)))

    def composed(self, asked: CountAutomaton) -> Grams:
        """The n-grams that ``asked`` holds too, with the counts of this automaton; numbers are those of ``asked``."""
        number = {w: i for i, w in enumerate(self.words)}
        names = np.array([number.get(w, -1) for w in asked.words], np.int64)
        many = max(1, len(self.words))
        origin = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        arcs_here = origin * many + self.label
        mine, theirs, rows = np.array([self.root]), np.array([asked.root]), np.zeros((1, 0), np.int64)
        out = []
        while len(theirs):
            fan = asked.first[theirs + 1] - asked.first[theirs]
            arc = np.repeat(asked.first[theirs], fan) + _within(fan)
            label, origin_here = names[asked.label[arc]], np.repeat(mine, fan)
            rows = np.column_stack([np.repeat(rows, fan, axis=0), asked.label[arc]])
            key = origin_here * many + label
            at = np.minimum(np.searchsorted(arcs_here, key), max(0, len(arcs_here) - 1))
            met = (label >= 0) & (arcs_here[at] == key) if len(arcs_here) else np.zeros(len(arc), bool)
            arc, at, rows = arc[met], at[met], rows[met]
            found = (asked.weight[arc] > 0) & (self.weight[at] > 0)
            out.append((rows[found], self.weight[at][found]))
            mine, theirs = self.target[at], asked.target[arc]
            on = (mine > 0) & (theirs > 0)
            mine, theirs, rows = mine[on], theirs[on], rows[on]
        out = [(r, c) for r, c in out if len(r)]
        width = max([r.shape[1] for r, _ in out], default=1)
        wide = [np.pad(r, ((0, 0), (0, width - r.shape[1])), constant_values=-1) for r, _ in out]
        if not wide:
            return Grams(asked.words, np.zeros((0, 1), np.int64), np.zeros(0, np.int64))
        return Grams(asked.words, np.concatenate(wide), np.concatenate([c for _, c in out]))

    def to_bytes(self) -> bytes:
        """Words hold no space, so one parts them."""
        listed = b" ".join(self.words)
        head = np.array([(len(listed), len(self.first) - 1, len(self.label))], _SIZES)
        columns = [np.diff(self.first).astype("<u4"), self.label.astype("<u4"), self.target.astype("<u4"), self.weight.astype("<i8")]
        return b"".join([head.tobytes(), *(c.tobytes() for c in columns), listed])

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        head = np.frombuffer(data, _SIZES, 1)[0]
        at = _SIZES.itemsize

        def column(kind: str, many: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, many, at)
            at += many * int(kind[-1])
            return found

        states, arcs = int(head["states"]), int(head["arcs"])
        fan, label, target, weight = column("<u4", states), column("<i4", arcs), column("<i4", arcs), column("<i8", arcs)
        listed = data[at : at + int(head["words"])]
        return cls(listed.split(b" ") if listed else [], np.concatenate([[0], np.cumsum(fan, dtype=np.int64)]), label, target, weight)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of consecutive runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
