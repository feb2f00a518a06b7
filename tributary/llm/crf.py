"""A linear-chain conditional random field over sequences of sparse features: training and Viterbi decoding.

The score of a sequence of labels is the sum of its features' weights for each label and of the weights of
neighbouring labels. Training maximises the labelled sequences' likelihood, less a quadratic penalty, by the
forward-backward recursions over all sequences at a time. Same sequences, same weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(x, axis=axis)


@dataclass
class Model:
    names: dict[str, int]
    emit: np.ndarray  # feature, label
    move: np.ndarray  # label, next label
    start: np.ndarray

    def scores(self, sequence: list[list[str]]) -> np.ndarray:
        names, emit = self.names, self.emit
        out = np.empty((len(sequence), emit.shape[1]))
        for i, features in enumerate(sequence):
            out[i] = emit[[names[f] for f in features if f in names]].sum(axis=0)
        return out

    def decode(self, sequence: list[list[str]], some: int | None = None) -> list[int]:
        """The likeliest labels; of equal ones the lower. With ``some``, the likeliest of those that have that label somewhere."""
        if not sequence:
            return []
        scores = self.scores(sequence)
        n = len(self.start)
        if some is None:
            start, move, emit, last = self.start, self.move, scores, np.zeros(n)
        else:  # each label twice: before the wanted one has come, and from then on
            never = -np.inf
            start = np.concatenate([np.where(np.arange(n) == some, never, self.start), np.where(np.arange(n) == some, self.start, never)])
            early = np.where(np.arange(n) == some, never, self.move)
            turn = np.where(np.arange(n) == some, self.move, never)
            move = np.block([[early, turn], [np.full((n, n), never), self.move]])
            emit, last = np.concatenate([scores, scores], axis=1), np.repeat([never, 0.0], n)
        best, back = start + emit[0], []
        for row in emit[1:]:
            ways = best[:, None] + move
            choice = ways.argmax(axis=0)
            back.append(choice)
            best = ways[choice, np.arange(len(choice))] + row
        label = int((best + last).argmax())
        out = [label]
        for choice in reversed(back):
            label = int(choice[label])
            out.append(label)
        return [x % n for x in out[::-1]]


def train(sequences: list[list[list[str]]], labels: list[list[int]], *, classes: int = 2, rounds: int = 120, rate: float = 0.4, penalty: float = 1e-5) -> Model:
    """Fits a model by Adam on the whole set of sequences, the rate falling to nothing."""
    names = {f: i for i, f in enumerate(sorted({f for s in sequences for x in s for f in x}))}
    n, longest = len(sequences), max(map(len, sequences))
    flat = np.zeros((sum(map(len, sequences)), len(names)), np.float32)
    y = np.zeros((n, longest), np.int64)
    size = np.array([len(s) for s in sequences])
    for i, ls in enumerate(labels):
        y[i, : len(ls)] = ls
    for row, features in zip(flat, (x for s in sequences for x in s), strict=True):
        row[[names[f] for f in features]] = 1
    there = np.arange(longest) < size[:, None]
    gold = np.eye(classes)[y] * there[..., None]
    gold_move = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    gold_start = gold[:, 0].sum(axis=0)
    total = size.sum()
    weights = [np.zeros((len(names), classes)), np.zeros((classes, classes)), np.zeros(classes)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        emit, move, start = weights
        score = np.zeros((n, longest, classes))
        score[there] = flat @ emit.astype(np.float32)
        ahead = np.zeros_like(score)
        behind = np.zeros_like(score)
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            new = lse(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        norm = lse(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            new = lse(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(there[:, t + 1, None], new, 0)
        at = np.exp(ahead + behind - norm[:, None, None]) * there[..., None]
        pair = ahead[:, :-1, :, None] + move + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        pairs = (np.exp(np.minimum(pair, 0)) * there[:, 1:, None, None]).sum(axis=(0, 1))
        slopes = [
            (flat.T @ (at - gold)[there].astype(np.float32)).astype(np.float64) / total + penalty * emit,
            (pairs - gold_move) / total + penalty * move,
            (at[:, 0].sum(axis=0) - gold_start) / n + penalty * start,
        ]
        for w, g, a, b in zip(weights, slopes, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (1 - (step - 1) / rounds) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model(names, *weights)
