"""A linear-chain conditional random field over two labels, fitted with numpy and decoded by Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Chain:
    """Weights of label 1 against label 0, a bias, and scores of label pairs (before, after)."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most likely labels of one sequence (rows are its places); ties go to label 0."""
        gain = (features @ self.weights + self.bias).tolist()
        (stay0, up), (down, stay1) = self.pairs.tolist()
        low, high, back = 0.0, gain[0], []
        for g in gain[1:]:
            from_low, from_high = low + stay0 >= high + down, low + up >= high + stay1
            back.append((from_low, from_high))
            low, high = (low + stay0 if from_low else high + down), (low + up if from_high else high + stay1) + g
        label = int(high > low)
        out = [label]
        for from_low, from_high in reversed(back):
            label = int(not (from_high if label else from_low))
            out.append(label)
        return np.array(out[::-1], np.int8)


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 200, rate: float = 0.1, ridge: float = 1e-3) -> Chain:
    """Maximum likelihood by Adam; the gradient comes from forward and backward sums.

    ``sequences`` holds (features, labels) pairs; all are padded to the longest, so their
    number and length must be bounded by the caller.
    """
    sequences = [s for s in sequences if len(s[1])]
    width = sequences[0][0].shape[1] if sequences else 1
    if not sequences:
        return Chain(np.zeros(width), 0.0, np.zeros((2, 2)))
    count, longest = len(sequences), max(len(y) for _, y in sequences)
    x, y, on = np.zeros((count, longest, width + 1)), np.zeros((count, longest), int), np.zeros((count, longest))
    for k, (features, labels) in enumerate(sequences):
        x[k, : len(labels), :-1], x[k, : len(labels), -1], y[k, : len(labels)], on[k, : len(labels)] = features, 1.0, labels, 1.0
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][on[:, 1:] > 0], y[:, 1:][on[:, 1:] > 0]), 1.0)
    total = on.sum()
    theta, moment, square = np.zeros(width + 5), np.zeros(width + 5), np.zeros(width + 5)
    for step in range(1, steps + 1):
        pairs = theta[width + 1 :].reshape(2, 2)
        score = np.zeros((count, longest, 2))
        score[:, :, 1] = x @ theta[: width + 1]
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            moved = log_sum(forward[:, t - 1, :, None] + pairs, 1) + score[:, t]
            forward[:, t] = np.where(on[:, t, None] > 0, moved, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = log_sum(pairs + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(on[:, t + 1, None] > 0, moved, 0.0)
        whole = log_sum(forward[:, -1], 1)
        here = np.exp(forward + backward - whole[:, None, None])[:, :, 1] * on
        both = forward[:, :-1, :, None] + pairs + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        both = np.exp(np.where(on[:, 1:, None, None] > 0, both, -np.inf)).sum((0, 1))
        gradient = np.concatenate([np.einsum("ktf,kt->f", x, (y - here) * on), (seen - both).ravel()]) / total
        gradient -= ridge * theta
        moment, square = 0.9 * moment + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        theta += rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Chain(theta[:width].copy(), float(theta[width]), theta[width + 1 :].reshape(2, 2).copy())
