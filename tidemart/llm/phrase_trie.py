"""A double-array trie over word keys, advanced for all text positions at once.

Words are found in a sorted array of 16-byte keys; their symbols are numbered
by how often they continue a phrase, so that large sets of children lie close
together. The child of state
``s`` under symbol ``c`` is ``base[s] + c`` if ``parent`` of that slot is ``s``;
the root's base is 0, so the state after one word is the word's symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

_ROOT, _FREE = -2, -1
#: Room per edge, which keeps the random bases few, and tries before there is more.
_SLOTS_PER_EDGE, _TRIES = 4, 50


class Trie(NamedTuple):
    keys: np.ndarray  # sorted word keys, 'S16'
    symbols: np.ndarray  # of each key
    base: np.ndarray
    parent: np.ndarray
    entry: np.ndarray  # of a slot: the place of the phrase that ends there, or -1

    def symbols_of(self, keys: np.ndarray) -> np.ndarray:
        """Symbol of each word key, -1 for words that begin or continue nothing."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.symbols[at], -1)

    def first(self, symbols: np.ndarray) -> np.ndarray:
        """States after one word (-1: dead)."""
        return np.where((symbols >= 0) & (self.parent[np.maximum(symbols, 0)] == _ROOT), symbols, -1)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """States after one more word; no state or symbol may be -1."""
        to = self.base[states] + symbols
        return np.where(self.parent[to] == states, to, -1)

    def reached(self, symbols: np.ndarray, joined: np.ndarray, longest: int,
                begins: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and states after two words, three, ...: every position (or those
        of ``begins``, by their place there) starts at the root, all of them
        advance level by level."""
        place = np.arange(len(symbols)) if begins is None else begins
        state = self.first(symbols[place])
        start = np.flatnonzero(state >= 0)
        place, state = place[start], state[start]
        for _ in range(longest - 1):
            on = joined[place]
            start, place, state = start[on], place[on] + 1, state[on]
            on = symbols[place] >= 0
            start, place, state = start[on], place[on], state[on]
            state = self.step(state, symbols[place])
            on = state >= 0
            start, place, state = start[on], place[on], state[on]
            if not len(place):
                return
            yield start, state

    def count(self, symbols: np.ndarray, joined: np.ndarray, longest: int) -> np.ndarray:
        """Occurrences per slot."""
        counts = np.zeros(len(self.base), np.int64)
        for _, state in self.reached(symbols, joined, longest):
            counts += np.bincount(state, minlength=len(counts))
        return counts

    def add_phrases(self, total: np.ndarray, symbols: np.ndarray, joined: np.ndarray, longest: int,
                    begins: np.ndarray | None = None, times: np.ndarray | None = None) -> None:
        """Add the occurrences of each phrase to ``total``: slots, of which there
        are many more, are not counted. With ``begins``, only phrases that begin
        there count, each as often as ``times`` says."""
        for start, state in self.reached(symbols, joined, longest, begins):
            ended = self.entry[state]
            on = ended >= 0
            if times is None:
                total += np.bincount(ended[on], minlength=len(total))
            else:
                np.add.at(total, ended[on], times[start[on]])


def _place(parent: np.ndarray, base: np.ndarray, heads: np.ndarray, owner: np.ndarray, sym: np.ndarray,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Find a base for every state of ``heads`` (edge i leaves ``heads[owner[i]]``
    under ``sym[i]``) at which all its children fall on free slots. All states
    try a random base at once; those that meet nothing stay, the rest try again.
    Returns the arrays, grown where they were too full."""
    span = int(sym.max()) + 1
    left = np.arange(len(heads))
    tries = 0
    while len(left):
        tries += 1
        if tries % _TRIES == 0:
            more = len(parent) // 2
            parent = np.concatenate([parent, np.full(more, _FREE, np.int32)])
            base = np.concatenate([base, np.zeros(more, np.int32)])
        at = np.zeros(len(heads), np.int64)
        at[left] = rng.integers(0, len(parent) - span, len(left))
        slot = at[owner] + sym
        order = np.argsort(slot, kind="stable")
        same = np.zeros(len(slot), bool)
        same[order[1:]] = slot[order[1:]] == slot[order[:-1]]
        met = np.zeros(len(heads), bool)
        met[owner[same | (parent[slot] != _FREE)]] = True
        done = left[~met[left]]
        base[heads[done]] = at[done]
        stays = ~met[owner]
        parent[slot[stays]] = heads[owner[stays]]
        left = left[met[left]]
        # go on with the edges of the states that are left
        rename = np.full(len(heads), -1)
        rename[left] = np.arange(len(left))
        heads, owner, sym = heads[left], rename[owner[~stays]], sym[~stays]
        left = np.arange(len(heads))
    return parent, base


def build(phrases: np.ndarray, words: np.ndarray) -> Trie:
    """Trie of phrases: row i of ``phrases`` ('S16') holds the keys of its
    words, its first ``words[i]`` columns count; rows are distinct."""
    n, longest = phrases.shape
    keys = np.unique(phrases[np.arange(longest) < words[:, None]])
    span = len(keys)
    syms = np.searchsorted(keys, phrases)
    later = np.bincount(syms[:, 1:][np.arange(1, longest) < words[:, None]], minlength=span)
    number = np.empty(span, np.int64)
    number[np.argsort(-later, kind="stable")] = np.arange(span)
    syms = np.append(number, 0)[np.minimum(syms, span)]  # what stands in unused columns does not matter
    size = 2 * span + _SLOTS_PER_EDGE * int((words - 1).sum()) + 64
    base, parent = np.zeros(size, np.int32), np.full(size, _FREE, np.int32)
    state = syms[:, 0].copy()
    parent[state] = _ROOT
    rng = np.random.default_rng(0)
    ends = np.full(n, -1, np.int64)
    for level in range(1, longest):
        rows = np.flatnonzero(words > level)
        if not len(rows):
            break
        edge = np.unique(state[rows] * span + syms[rows, level])
        heads, begin, sizes = np.unique(edge // span, return_index=True, return_counts=True)
        # the states with the most children choose first
        kinds = np.floor(np.log2(sizes)).astype(int)
        for kind in range(kinds.max(), -1, -1):
            some = np.flatnonzero(kinds == kind)
            if len(some):
                owner = np.repeat(np.arange(len(some)), sizes[some])
                at = np.repeat(begin[some] - np.cumsum(sizes[some]) + sizes[some], sizes[some]) + np.arange(len(owner))
                parent, base = _place(parent, base, heads[some], owner, edge[at] % span, rng)
        state[rows] = base[state[rows]] + syms[rows, level]
        done = rows[words[rows] == level + 1]
        ends[done] = state[done]
    size = int(base.max()) + span + 1
    if size > len(parent):
        parent = np.concatenate([parent, np.full(size - len(parent), _FREE, np.int32)])
        base = np.concatenate([base, np.zeros(size - len(base), np.int32)])
    entry = np.full(size, -1, np.int32)
    entry[ends[ends >= 0]] = np.flatnonzero(ends >= 0)
    return Trie(keys, number, base[:size], parent[:size], entry)
