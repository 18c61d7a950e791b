"""Linear-chain conditional random fields in numpy.

Tokens of many sequences lie end to end, ``first`` marks where each begins.  Chains of
two states run through products of 2 x 2 matrices, cut into blocks that advance
together, so a long sequence costs no more than short ones of the same total length.
Chains of more states (short sequences, such as the blocks of a page) step through time
together.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 32

Matrices = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _scan(m: Matrices) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each matrix of a chain the row vector that reaches it and the column vector behind it."""
    n = len(m[0])
    if n <= 2 * _BLOCK:
        f, b = np.empty((2, n)), np.empty((2, n))
        x, y = 1.0, 0.0
        for k in range(n):
            f[0, k], f[1, k] = x, y
            x, y = x * m[0][k] + y * m[2][k], x * m[1][k] + y * m[3][k]
            scale = 1.0 / max(x + y, 1e-300)
            x, y = x * scale, y * scale
        x, y = 1.0, 1.0
        for k in range(n - 1, -1, -1):
            b[0, k], b[1, k] = x, y
            x, y = m[0][k] * x + m[1][k] * y, m[2][k] * x + m[3][k] * y
            scale = 1.0 / max(x + y, 1e-300)
            x, y = x * scale, y * scale
        return f[0], f[1], b[0], b[1]
    blocks = -(-n // _BLOCK)
    rest = blocks * _BLOCK - n
    shaped = []
    for part, filler in zip(m, (1.0, 0.0, 0.0, 1.0)):
        part = np.concatenate([part, np.full(rest, filler)]) if rest else part
        shaped.append(np.ascontiguousarray(part.reshape(blocks, _BLOCK).T))
    a, b, c, d = shaped
    p = (a[0], b[0], c[0], d[0])
    for k in range(1, _BLOCK):
        p = (
            p[0] * a[k] + p[1] * c[k],
            p[0] * b[k] + p[1] * d[k],
            p[2] * a[k] + p[3] * c[k],
            p[2] * b[k] + p[3] * d[k],
        )
    top = np.maximum(np.maximum(p[0], p[1]), np.maximum(p[2], p[3]))
    x, y, u, v = _scan(tuple(part / np.maximum(top, 1e-300) for part in p))
    f0, f1, b0, b1 = (np.empty((_BLOCK, blocks)) for _ in range(4))
    for k in range(_BLOCK):
        f0[k], f1[k] = x, y
        x, y = x * a[k] + y * c[k], x * b[k] + y * d[k]
    for k in range(_BLOCK - 1, -1, -1):
        b0[k], b1[k] = u, v
        u, v = a[k] * u + b[k] * v, c[k] * u + d[k] * v
    return tuple(part.T.ravel()[:n] for part in (f0, f1, b0, b1))


def binary_marginals(odds: np.ndarray, first: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(state 1) of each token, and the expected count of each move within sequences (2 x 2).

    ``odds`` are log-odds of the tokens, ``start`` those of a first token, ``moves``
    the log weights of the moves.
    """
    if not len(odds):
        return np.zeros(0), np.zeros((2, 2))
    one = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
    zero = 1.0 - one
    w = np.exp(np.clip(moves, -20, 20))
    w /= w.max()
    m = [zero * w[0, 0], one * w[0, 1], zero * w[1, 0], one * w[1, 1]]
    heads = first[:-1][first[:-1] < first[1:]]
    s = 1.0 / (1.0 + np.exp(-np.clip(start, -30, 30)))
    # A first token forgets what came before: both rows are the same.
    m[0][heads] = m[2][heads] = zero[heads] * (1 - s)
    m[1][heads] = m[3][heads] = one[heads] * s
    f0, f1, b0, b1 = _scan(tuple(m))
    joint = np.stack([f0 * m[0] * b0, f0 * m[1] * b1, f1 * m[2] * b0, f1 * m[3] * b1])
    joint /= np.maximum(joint.sum(axis=0), 1e-300)
    p = joint[1] + joint[3]
    joint[:, heads] = 0
    return p, joint.sum(axis=1).reshape(2, 2)


def fit_binary(
    slots: np.ndarray, size: int, labels: np.ndarray, first: np.ndarray, rounds: int = 40, rate: float = 0.5, ridge: float = 1e-3
) -> tuple[np.ndarray, float, np.ndarray]:
    """Slot weights, start and moves that make the labels likely (AdaGrad on the exact gradient).

    ``slots`` has a row of feature slots for each token.
    """
    weight, start, moves = np.zeros(size), 0.0, np.zeros((2, 2))
    heads = first[:-1][first[:-1] < first[1:]]
    seen_moves = np.zeros((2, 2))
    inner = np.ones(len(labels), dtype=bool)
    inner[heads] = False
    at = np.flatnonzero(inner)
    np.add.at(seen_moves, (labels[at - 1], labels[at]), 1)
    past_w, past_s, past_m = np.full(size, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    flat, width = slots.ravel(), slots.shape[1]
    for _ in range(rounds):
        odds = weight[slots].sum(axis=1)
        p, expected = binary_marginals(odds, first, start, moves)
        error = p - labels
        g = np.bincount(flat, np.repeat(error, width), size) + ridge * weight
        g_start = float(error[heads].sum()) + ridge * start
        g_moves = expected - seen_moves + ridge * moves
        past_w += g * g
        past_s += g_start * g_start
        past_m += g_moves * g_moves
        weight -= rate * g / np.sqrt(past_w)
        start -= rate * g_start / past_s**0.5
        moves -= rate * g_moves / np.sqrt(past_m)
    return weight, start, moves


def _steps(first: np.ndarray):
    """For each time step the tokens of all sequences that are so long, longest sequence first."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, ascending = first[:-1][order], np.sort(sizes)
    for t in range(int(sizes.max(initial=0))):
        alive = len(sizes) - int(np.searchsorted(ascending, t, side="right"))
        yield t, begin[:alive] + t


def viterbi(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best state of each token; of equal paths the one with lower states."""
    back = np.zeros(scores.shape, np.int8)
    best = np.zeros(scores.shape)
    sizes = np.diff(first)
    for t, at in _steps(first):
        if t == 0:
            best[at] = start + scores[at]
            continue
        ways = best[at - 1][:, :, None] + moves[None]
        back[at] = ways.argmax(axis=1)
        best[at] = ways.max(axis=1) + scores[at]
    state = np.zeros(len(scores), np.int64)
    last = first[1:][sizes > 0] - 1
    state[last] = best[last].argmax(axis=1)
    for t, at in reversed(list(_steps(first))):
        if t:
            state[at - 1] = back[at, state[at]]
    return state


def marginals(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(state) of each token and the expected counts of moves."""
    steps = list(_steps(first))
    ahead, behind = np.zeros(scores.shape), np.zeros(scores.shape)

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for t, at in steps:
        ahead[at] = scores[at] + (start if t == 0 else log_sum(ahead[at - 1][:, :, None] + moves[None], 1))
    expected = np.zeros(moves.shape)
    for t, at in reversed(steps):
        if t:
            behind[at - 1] = log_sum(moves[None] + (scores[at] + behind[at])[:, None, :], 2)
    p = ahead + behind
    p = np.exp(p - p.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    for t, at in steps:
        if t:
            pair = ahead[at - 1][:, :, None] + moves[None] + (scores[at] + behind[at])[:, None, :]
            pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return p, expected


def fit(
    slots: np.ndarray, size: int, labels: np.ndarray, first: np.ndarray, states: int, rounds: int = 60, rate: float = 0.5, ridge: float = 1e-2
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``fit_binary`` for any number of states: weights (slots x states), start, moves."""
    weight, start, moves = np.zeros((size, states)), np.zeros(states), np.zeros((states, states))
    sizes = np.diff(first)
    heads = first[:-1][sizes > 0]
    hot = np.eye(states)[labels]
    inner = np.ones(len(labels), dtype=bool)
    inner[heads] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((states, states))
    np.add.at(seen, (labels[at - 1], labels[at]), 1)
    past = [np.full(x.shape, 1e-6) for x in (weight, start, moves)]
    flat, width = slots.ravel(), slots.shape[1]
    for _ in range(rounds):
        p, expected = marginals(weight[slots].sum(axis=1), first, start, moves)
        error = p - hot
        g_w = np.stack([np.bincount(flat, np.repeat(error[:, s], width), size) for s in range(states)], axis=1)
        for x, g, h in zip((weight, start, moves), (g_w, error[heads].sum(axis=0), expected - seen), past):
            g = g + ridge * x
            h += g * g
            x -= rate * g / np.sqrt(h)
    return weight, start, moves
