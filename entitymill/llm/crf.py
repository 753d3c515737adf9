"""A linear-chain conditional random field with two labels, for all texts of a batch at once.

A chain is a row of tokens; each token has small numbered features. The score of a labelling is
the sum of a weight per (feature, label) and a weight per pair of neighbouring labels. Forward and
backward passes run over blocks of tokens in step, then over the blocks of a chain, so long chains
do not need long loops.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 64


@dataclass
class Weights:
    """emit: (features, sizes, 2) tables per feature slot; pair: (2, 2) from label to label."""

    emit: list[np.ndarray]
    pair: np.ndarray

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return sum(table[x] for table, x in zip(self.emit, features, strict=True))


def _scaled(m: np.ndarray, axes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    top = m.max(axis=axes, keepdims=True)
    return m / top, np.log(top)


def marginals(emit: np.ndarray, pair: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label probabilities (n, 2), probabilities of neighbouring labels summed (2, 2), log partition.

    emit: (n, 2) scores of all tokens; first: first token of each chain, and the end.
    """
    n = len(emit)
    if not n:
        return np.zeros((0, 2)), np.zeros((2, 2)), 0.0
    lengths = np.diff(first)
    chains = np.flatnonzero(lengths)
    lengths, start = lengths[chains], first[:-1][chains]
    blocks = -(-lengths // STEP)
    head = np.cumsum(blocks) - blocks  # first block of each chain
    chain = np.repeat(np.arange(len(chains)), blocks)
    number = np.arange(len(chain)) - head[chain]
    token = start[chain] + number * STEP
    size = np.minimum(lengths[chain] - number * STEP, STEP)

    top = emit.max(axis=1)
    local = np.exp(emit - top[:, None])
    move = np.exp(pair)
    opens = np.zeros(n, bool)
    opens[start] = True
    # of each token: products of the steps of its block up to it, and after it
    ahead = np.zeros((n, 2, 2))
    behind = np.zeros((n, 2, 2))
    log_z = float(top.sum())

    def steps(at: np.ndarray) -> np.ndarray:
        """From the label before a token to its own; a first token has no label before."""
        m = move[None] * local[at][:, None, :]
        m[opens[at]] = np.eye(2) * local[at[opens[at]]][:, None, :]
        return m

    held = np.broadcast_to(np.eye(2), (len(chain), 2, 2)).copy()
    scale = np.zeros(len(chain))
    for i in range(min(STEP, int(size.max()))):
        live = np.flatnonzero(size > i)
        at = token[live] + i
        m, log_top = _scaled(held[live] @ steps(at), (1, 2))
        held[live] = ahead[at] = m
        scale[live] += log_top[:, 0, 0]
    back = np.broadcast_to(np.eye(2), (len(chain), 2, 2)).copy()
    for i in range(min(STEP, int(size.max())) - 1, -1, -1):
        live = np.flatnonzero(size > i)
        at = token[live] + i
        behind[at] = back[live]
        back[live] = _scaled(steps(at) @ back[live], (1, 2))[0]
    # along the blocks of each chain: what comes in from the left, and from the right
    left = np.ones((len(chain), 2))
    right = np.ones((len(chain), 2))
    at_left, at_right = np.ones((len(chains), 2)), np.ones((len(chains), 2))
    for i in range(int(blocks.max())):
        live = np.flatnonzero(blocks > i)
        block = head[live] + i
        left[block] = at_left[live]
        v, log_top = _scaled(np.einsum("ci,cij->cj", at_left[live], held[block]), (1,))
        at_left[live] = v
        log_z += float(log_top.sum() + scale[block].sum())
        block = head[live] + blocks[live] - 1 - i
        right[block] = at_right[live]
        at_right[live] = _scaled(np.einsum("cij,cj->ci", back[block], at_right[live]), (1,))[0]
    log_z += float(np.log(at_left.sum(axis=1)).sum())
    owner = np.repeat(np.arange(len(chain)), size)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + token[owner]
    alpha, beta = np.empty((n, 2)), np.empty((n, 2))
    alpha[place] = np.einsum("ci,cij->cj", left[owner], ahead[place])
    beta[place] = np.einsum("cij,cj->ci", behind[place], right[owner])
    own = alpha * beta
    own /= own.sum(axis=1, keepdims=True)
    inner = np.flatnonzero(~opens)
    both = alpha[inner - 1][:, :, None] * move[None] * (local[inner] * beta[inner])[:, None, :]
    both /= both.sum(axis=(1, 2), keepdims=True)
    return own, both.sum(axis=0), log_z


def fit(
    features: list[np.ndarray], sizes: list[int], labels: np.ndarray, first: np.ndarray,
    rounds: int = 60, rate: float = 0.5, ridge: float = 1e-3,
) -> Weights:
    """Weights by gradient ascent on the likelihood of the labels, with adaptive steps."""
    weights = Weights([np.zeros((s, 2)) for s in sizes], np.zeros((2, 2)))
    n = max(len(labels), 1)
    truth = np.eye(2)[labels]
    opens = np.zeros(len(labels) + 1, bool)
    opens[first] = True
    inner = np.flatnonzero(~opens[: len(labels)])
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (labels[inner - 1], labels[inner]), 1.0)
    tables = [*weights.emit, weights.pair]
    seen = [np.zeros_like(t) for t in tables]
    for _ in range(rounds):
        own, both, _ = marginals(weights.scores(features), weights.pair, first)
        slopes = [np.stack([np.bincount(x, (truth - own)[:, k], s) for k in (0, 1)], 1)
                  for x, s in zip(features, sizes, strict=True)] + [pairs - both]
        for table, slope, past in zip(tables, slopes, seen, strict=True):
            slope = slope / n - ridge * table / 100
            past += slope * slope
            table += rate * slope / (np.sqrt(past) + 1e-9)
    return weights
