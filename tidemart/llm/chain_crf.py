"""A linear-chain conditional random field on arrays: exact marginals by
forward-backward for many chains at once, and a fit by gradient ascent.

Chains stand one after the other in the score array (``sizes`` long each). They
are cut into blocks of ``BLOCK`` positions. The products of the blocks' step
matrices carry the messages from block to block, and then all blocks run inside
at once: a chain of a million words takes as many numpy steps as there are
blocks in it, not words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 64


class _Blocks(NamedTuple):
    place: np.ndarray  # (blocks, BLOCK): position in the score array, 0 where unused
    used: np.ndarray
    first: np.ndarray  # first block of each chain
    count: np.ndarray  # blocks of each chain


def _blocks(sizes: np.ndarray) -> _Blocks:
    count = -(-sizes // BLOCK)
    first = np.cumsum(count) - count
    chain = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(chain)) - first[chain]
    start = (np.cumsum(sizes) - sizes)[chain] + nth * BLOCK
    left = sizes[chain] - nth * BLOCK
    k = np.arange(BLOCK)
    used = k < left[:, None]
    return _Blocks(np.where(used, start[:, None] + k, 0), used, first, count)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray,
              pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label at each position, and (``pairs``) the expected
    number of each label pair in neighbouring positions, else zeros. All
    arguments are logarithms; the first position of a chain has no transition."""
    n, labels = scores.shape
    expected = np.zeros((labels, labels))
    if n == 0:
        return scores.copy(), expected
    sizes = np.asarray(sizes)[np.asarray(sizes) > 0]
    b = _blocks(sizes)
    step = np.exp(transitions - transitions.max())
    free = np.exp(scores - scores.max(axis=1, keepdims=True))
    emit = np.where(b.used[:, :, None], free[b.place], 1.0)
    starts = np.zeros(len(b.place), bool)
    starts[b.first] = True

    # what a block does to a message: the product of its steps
    through = np.broadcast_to(np.eye(labels), (len(b.place), labels, labels)).copy()
    for k in range(BLOCK):
        on = b.used[:, k]
        if not on.any():
            break
        moved = through[on]
        if k == 0:
            moved = np.where(starts[on][:, None, None], 1.0, moved @ step)
        else:
            moved = moved @ step
        moved = moved * emit[on, k][:, None, :]
        through[on] = moved / moved.max(axis=(1, 2), keepdims=True)

    # messages that enter each block from the left and from the right
    left = np.full((len(b.place), labels), 1.0 / labels)
    right = np.ones((len(b.place), labels))
    longest = int(b.count.max())
    for j in range(1, longest):
        at = b.first[b.count > j] + j
        left[at] = _normal(np.einsum("bi,bij->bj", left[at - 1], through[at - 1]))
    for j in range(1, longest):
        some = b.count > j
        at = (b.first + b.count - 1)[some] - j
        right[at] = _normal(np.einsum("bij,bj->bi", through[at + 1], right[at + 1]))

    forward = np.empty_like(emit)
    message = left
    for k in range(BLOCK):
        to = message @ step
        if k == 0:
            to[starts] = 1.0
        to = _normal(to * emit[:, k])
        message = np.where(b.used[:, k, None], to, message)
        forward[:, k] = message
    out = np.empty_like(scores)
    message = right
    for k in range(BLOCK - 1, -1, -1):
        on = b.used[:, k]
        out[b.place[on, k]] = _normal(forward[on, k] * message[on])
        back = emit[:, k] * message
        if pairs:
            # label pairs between the position before and this one
            before = forward[:, k - 1] if k else left
            some = on & ~starts if k == 0 else on
            joint = before[some][:, :, None] * step * back[some][:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        message = np.where(on[:, None], _normal(back @ step.T), message)
    return out, expected


class Weights(NamedTuple):
    features: np.ndarray  # (buckets, labels)
    lexicon: float
    transitions: np.ndarray  # (labels, labels)


class Sparse(NamedTuple):
    """Features of distinct words: entries (word, bucket, value)."""

    word: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    n: int


def word_scores(w: Weights, sparse: Sparse, lexicon: np.ndarray) -> np.ndarray:
    """(words, labels): weighted features plus the weighted lexicon."""
    out = w.lexicon * lexicon
    for y in range(lexicon.shape[1]):
        out[:, y] += np.bincount(sparse.word, sparse.value * w.features[sparse.bucket, y], sparse.n)
    return out


def gradient(w: Weights, sparse: Sparse, lexicon: np.ndarray, ids: np.ndarray, labels: np.ndarray,
             sizes: np.ndarray, l2: float) -> Weights:
    """Of the mean log-likelihood per position less ``l2`` times the squared
    feature weights. ``lexicon``: one row a position."""
    n, k = lexicon.shape
    scores = word_scores(w._replace(lexicon=0.0), sparse, np.zeros((sparse.n, k)))[ids] + w.lexicon * lexicon
    got, pairs = marginals(scores, sizes, w.transitions, pairs=True)
    off = -got
    off[np.arange(n), labels] += 1
    seen = np.zeros((k, k))
    inner = np.ones(n, bool)
    inner[np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]] = False
    at = np.flatnonzero(inner)
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    features = np.empty_like(w.features)
    for y in range(k):
        of_word = np.bincount(ids, off[:, y], sparse.n)
        features[:, y] = np.bincount(sparse.bucket, sparse.value * of_word[sparse.word], len(features))
    return Weights(features / n - 2 * l2 * w.features, float((off * lexicon).sum() / n), (seen - pairs) / n)


def fit(n_buckets: int, sparse: Sparse, lexicon: np.ndarray, ids: np.ndarray, labels: np.ndarray,
        sizes: np.ndarray, *, rounds: int = 40, rate: float = 0.3, l2: float = 1e-6) -> Weights:
    """Adam on the whole sample; the result depends on the arguments alone."""
    k = lexicon.shape[1]
    w = [np.zeros((n_buckets, k)), np.zeros(()), np.zeros((k, k))]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for t in range(1, rounds + 1):
        g = gradient(Weights(w[0], float(w[1]), w[2]), sparse, lexicon, ids, labels, sizes, l2)
        for i, x in enumerate(g):
            m[i] = 0.9 * m[i] + 0.1 * x
            v[i] = 0.99 * v[i] + 0.01 * np.square(x)
            w[i] = w[i] + rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
    return Weights(w[0], float(w[1]), w[2])
