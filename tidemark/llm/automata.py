"""Weighted acyclic automata over words: counts of phrases, in minimal form.

A phrase is a tuple of words (bytes).  States are shared wherever the same
words may follow, so weights can't stand on them: a phrase's weight stands at
its place in the sorted order, which the walk to it counts off by how many
phrases each state leads to.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np

Phrase = tuple[bytes, ...]


class Automaton:
    """States by number: whether a phrase ends there, and its arcs as (word, state) in order; sizes are the phrases that each leads to."""

    def __init__(self) -> None:
        self.finals: list[bool] = []
        self.arcs: list[tuple[tuple[bytes, int], ...]] = []
        self.sizes: list[int] = []
        self.weights: list[int] = []
        self.root = -1

    @classmethod
    def of(cls, phrases: Iterable[tuple[Phrase, int]]) -> Automaton:
        """Incremental construction from phrases in order, each once: what the next phrase doesn't begin with is final and finds its equal, if there's one."""
        out, known = cls(), {}
        # states on the way of the last phrase, which may still change
        way: list[tuple[list[bool], list[tuple[bytes, int]]]] = [([False], [])]
        last: Phrase = ()

        def close(down_to: int) -> None:
            while len(way) > down_to:
                (final,), arcs = way.pop()
                key = (final, tuple(arcs))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(out.finals)
                    out.finals.append(final)
                    out.arcs.append(key[1])
                    out.sizes.append(final + sum(out.sizes[s] for _, s in arcs))
                if way:
                    way[-1][1].append((last[len(way) - 1], state))
                else:
                    out.root = state

        for phrase, weight in phrases:
            shared = 0
            for a, b in zip(phrase, last, strict=False):
                if a != b:
                    break
                shared += 1
            close(shared + 1)
            way.extend(([False], []) for _ in phrase[shared:])
            way[-1][0][0] = True
            out.weights.append(weight)
            last = phrase
        close(0)
        return out

    def __iter__(self) -> Iterator[tuple[Phrase, int]]:
        """Phrases in order, with their weights."""
        at = iter(self.weights)
        stack: list[tuple[Phrase, int]] = [((), self.root)]
        while stack:
            phrase, state = stack.pop()
            if self.finals[state]:
                yield phrase, next(at)
            stack.extend(((*phrase, word), to) for word, to in reversed(self.arcs[state]))

    def to_bytes(self) -> bytes:
        """Words in order, then the numbers of states, arcs and weights."""
        words = sorted({w for arcs in self.arcs for w, _ in arcs})
        number = {w: k for k, w in enumerate(words)}
        text = b"\n".join(words)
        flat = [(number[w], s) for arcs in self.arcs for w, s in arcs]
        labels, targets = (np.array([x[k] for x in flat], dtype="<i4") for k in (0, 1))
        head = np.array([len(text), len(words), len(self.finals), len(flat), len(self.weights), self.root], dtype="<i8")
        counts = np.array([len(a) for a in self.arcs], dtype="<i4")
        parts = (head, np.array(self.weights, dtype="<i8"), counts, labels, targets, np.array(self.finals, dtype="<u1"))
        return b"".join(p.tobytes() for p in parts) + text

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        out, at = cls(), 48
        n_text, n_words, n_states, n_arcs, n_weights, out.root = np.frombuffer(data, "<i8", 6).tolist()

        def numbers(kind: str, n: int) -> list[int]:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found.tolist()

        out.weights, counts, labels, targets = numbers("<i8", n_weights), numbers("<i4", n_states), numbers("<i4", n_arcs), numbers("<i4", n_arcs)
        out.finals = [bool(x) for x in numbers("<u1", n_states)]
        words = data[at : at + n_text].split(b"\n") if n_words else []
        start = 0
        for n in counts:
            arcs = tuple((words[labels[k]], targets[k]) for k in range(start, start + n))
            start += n
            out.arcs.append(arcs)
            out.sizes.append(out.finals[len(out.arcs) - 1] + sum(out.sizes[s] for _, s in arcs))
        return out


def union(automata: list[Automaton], least: int = 1) -> Automaton:
    """The automaton of all phrases whose weights sum to at least this much."""
    merged = heapq.merge(*automata)
    sums = ((phrase, sum(w for _, w in same)) for phrase, same in groupby(merged, key=lambda x: x[0]))
    return Automaton.of((p, w) for p, w in sums if w >= least)


def composed(asked: Automaton, counts: Automaton) -> Iterator[tuple[Phrase, int]]:
    """The phrases that both have, in order, with the weights of counts: pairs of states are walked together."""
    stack: list[tuple[Phrase, int, int, int]] = [((), asked.root, counts.root, 0)]
    while stack:
        phrase, a, b, place = stack.pop()
        if asked.finals[a] and counts.finals[b]:
            yield phrase, counts.weights[place]
        place += counts.finals[b]
        wanted, ahead = dict(asked.arcs[a]), []
        for word, to in counts.arcs[b]:
            if word in wanted:
                ahead.append(((*phrase, word), wanted[word], to, place))
            place += counts.sizes[to]
        stack.extend(reversed(ahead))
