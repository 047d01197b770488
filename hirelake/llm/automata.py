"""Levenshtein automata intersected with a lexicon trie, as one deterministic table that runs over arrays of words."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np

DEAD, START = 0, 1


@dataclass(frozen=True)
class LexiconAutomaton:
    """``step[state, letter]`` leads on; ``term``/``errors`` of a state tell what a word that ends there is (-1: none)."""

    step: np.ndarray
    term: np.ndarray
    errors: np.ndarray
    stays: np.ndarray  # by state: no letter leads away from a match, as after a stem
    letters: dict[str, int]  # letter -> column, from 1; column 0 is any other letter
    longest: int

    def match(self, word: str) -> tuple[int, int] | None:
        state = START
        for c in word:
            state = int(self.step[state, self.letters.get(c, 0)])
        return None if self.term[state] < 0 else (int(self.term[state]), int(self.errors[state]))


def allowed_errors(term: str) -> int:
    """Edits at which a longer word is still more likely a misspelling than another word."""
    return 0 if len(term) < 5 else 1


def compile_lexicon(terms: Mapping[str, bool], errors=allowed_errors) -> LexiconAutomaton:
    """The product of the terms' trie and the automaton that counts edits (insert, delete, replace), determinised.

    ``terms`` maps a term to whether it is a stem; a stem matches every word that begins with it, without edits. Of
    several matches the one with fewest edits counts, then a whole term before a stem, then the longest.
    """
    order = sorted(terms, key=lambda t: (terms[t], -len(t), t))
    number = {t: i for i, t in enumerate(order)}
    alphabet = sorted({c for t in order for c in t})
    letters = {c: i + 1 for i, c in enumerate(alphabet)}
    child: list[dict[str, int]] = [{}]
    ends: list[dict[bool, str]] = [{}]
    budget = [0]
    for t in order:
        node, k = 0, 0 if terms[t] else errors(t)
        budget[0] = max(budget[0], k)
        for c in t:
            if c not in child[node]:
                child[node][c] = len(child)
                child.append({})
                ends.append({})
                budget.append(0)
            node = child[node][c]
            budget[node] = max(budget[node], k)
        ends[node][terms[t]] = t

    def closed(states: dict) -> frozenset:
        """Fewest edits for each node, letters of terms left out included; a matched stem stays as ``~number``."""
        open_ = list(states)
        while open_:
            node = open_.pop()
            if node < 0:
                continue
            e = states[node] + 1
            for below in child[node].values():
                if e <= budget[below] and states.get(below, 9) > e:
                    states[below] = e
                    open_.append(below)
        for node, e in list(states.items()):
            if node >= 0 and e == 0 and True in ends[node]:
                states.setdefault(~number[ends[node][True]], 0)
        return frozenset(states.items())

    def moved(states: frozenset, c: str | None) -> frozenset:
        out: dict[int, int] = {}

        def reach(node, e):
            if out.get(node, 9) > e:
                out[node] = e

        for node, e in states:
            if node < 0:
                reach(node, 0)
                continue
            if e + 1 <= budget[node]:
                reach(node, e + 1)
            for letter, below in child[node].items():
                if letter == c:
                    reach(below, e)
                elif e + 1 <= budget[below]:
                    reach(below, e + 1)
        return closed(out)

    known = {frozenset(): DEAD, closed({0: 0}): START}
    rows, queue = {DEAD: [DEAD] * (len(alphabet) + 1)}, [next(s for s, i in known.items() if i == START)]
    accept = {DEAD: (-1, 0)}
    for states in queue:
        row = []
        for c in (None, *alphabet):
            to = moved(states, c)
            if to not in known:
                known[to] = len(known)
                queue.append(to)
            row.append(known[to])
        rows[known[states]] = row
        whole = [(e, number[ends[n][False]]) for n, e in states if n >= 0 and False in ends[n]
                 and e <= errors(ends[n][False])]
        stems = [(0, ~n) for n, e in states if n < 0]
        found = min([*((e, 0, t) for e, t in whole), *((e, 1, t) for e, t in stems)], default=(0, 0, -1))
        accept[known[states]] = (found[2], found[0])
    table = np.array([rows[i] for i in range(len(known))], np.int32)
    term = np.array([accept[i][0] for i in range(len(known))], np.int32)
    stays = (table == np.arange(len(known))[:, None]).all(axis=1) & (term >= 0)
    return LexiconAutomaton(
        table, term, np.array([accept[i][1] for i in range(len(known))], np.int32), stays, letters, max(map(len, order), default=0) + 1,
    )
