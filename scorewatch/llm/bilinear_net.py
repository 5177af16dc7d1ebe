"""Log-bilinear model of the next symbol from the symbols before it, in numpy.

The context's vectors, weighted place by place, add up to a predicted vector; a symbol's score is its product
with the symbol's own vector, plus a bias. Noise-contrastive estimation trains the scores against symbols
drawn from their plain frequencies, the same draw for a whole batch, so that a step is a few matrix products.
Probabilities are normalised over all symbols.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

#: Symbols before the predicted one, nearest first.
CONTEXT = 4
SIZE = 32
BATCH = 512
NOISE = 64
RATE = 0.1
#: Tokens whose sums are formed at once.
BLOCK = 256
#: Sums below this are not taken from products.
LEAST = 1e-25


@dataclass
class Network:
    """Vectors of context symbols and of predicted ones, weights of the places, biases; the last symbol is never predicted."""

    context: np.ndarray
    output: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @classmethod
    def initial(cls, frequency: np.ndarray, seed: int = 11) -> Network:
        """Small random vectors, the logarithm of a symbol's frequency as its bias."""
        rng = np.random.default_rng(seed)
        n = len(frequency)
        draw = lambda rows: (rng.standard_normal((rows, SIZE)) * 0.1).astype(np.float32)
        return cls(draw(n + 1), draw(n), np.ones((CONTEXT, SIZE), np.float32), np.log(frequency).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.output, self.places, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def view(self, numbers: np.ndarray) -> None:
        """Take the parts from a row of numbers without a copy."""
        cuts = np.cumsum([p.size for p in self.parts()])[:-1]
        views = [v.reshape(p.shape) for v, p in zip(np.split(numbers, cuts), self.parts(), strict=True)]
        self.context, self.output, self.places, self.bias = views

    @classmethod
    def from_flat(cls, numbers: np.ndarray, symbols: int) -> Network:
        shapes = [(symbols + 1, SIZE), (symbols, SIZE), (CONTEXT, SIZE), (symbols,)]
        cuts = np.cumsum([np.prod(s) for s in shapes])[:-1]
        return cls(*(p.reshape(s).astype(np.float32) for p, s in zip(np.split(numbers, cuts), shapes, strict=True)))

    def predicted(self, before: np.ndarray) -> np.ndarray:
        """Predicted vectors; ``before`` has a column of symbols per place."""
        out = np.take(self.context, before[:, 0], axis=0)
        out *= self.places[0]
        for k in range(1, CONTEXT):
            held = np.take(self.context, before[:, k], axis=0)
            held *= self.places[k]
            out += held
        return out

    def log_probabilities(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target, normalised over all symbols.

        A score is a sum over the places, so the scores of every symbol at every place come from one matrix
        product each, and their exponentials are taken once: a token's sum over all symbols is then a sum of
        products of four rows. Each row is taken relative to its maximum, so that no product leaves the range of the
        numbers; the few tokens whose sums are too small for them are read score by score.
        """
        scores = [(self.context * p) @ self.output.T for p in self.places]
        scores[0] = scores[0] + self.bias
        tops = [s.max(axis=1) for s in scores]
        powers = [np.exp(s - top[:, None]) for s, top in zip(scores, tops, strict=True)]
        found = np.empty(len(target))
        # Two blocks only, so that tables and blocks stay near the processor.
        product, rows = (np.empty((BLOCK, len(self.output)), np.float32) for _ in range(2))
        for start in range(0, len(target), BLOCK):
            part = slice(start, start + BLOCK)
            held, of = before[part], target[part]
            all_, one = product[: len(of)], rows[: len(of)]
            np.take(powers[0], held[:, 0], axis=0, out=all_, mode="clip")
            for k in range(1, CONTEXT - 1):
                all_ *= np.take(powers[k], held[:, k], axis=0, out=one, mode="clip")
            np.take(powers[-1], held[:, CONTEXT - 1], axis=0, out=one, mode="clip")
            own = sum(s[held[:, k], of] - tops[k][held[:, k]] for k, s in enumerate(scores))
            sums = np.einsum("ij,ij->i", all_, one)
            low = np.flatnonzero(sums < LEAST)
            sums[low] = 1
            found[part] = own - np.log(sums)
            if len(low):
                found[start + low] = self._shifted(scores, held[low], of[low])
        return found

    def _shifted(self, scores: list[np.ndarray], before: np.ndarray, target: np.ndarray) -> np.ndarray:
        found = np.empty(len(target))
        for start in range(0, len(target), BLOCK):
            part = slice(start, start + BLOCK)
            block = sum(s[before[part, k]] for k, s in enumerate(scores))
            block -= block.max(axis=1, keepdims=True)
            own = block[np.arange(len(block)), target[part]]
            found[part] = own - np.log(np.exp(block).sum(axis=1))
        return found


@cache
def _cells(n: int, width: int) -> np.ndarray:
    return np.arange(n * width).reshape(n, width)


def _summed_rows(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each index below ``n``; an index may repeat."""
    cells = np.take(_cells(n, rows.shape[1]), index, axis=0)
    return np.bincount(cells.ravel(), rows.ravel(), n * rows.shape[1]).reshape(n, -1).astype(np.float32)


def _falling(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place."""
    np.exp(np.minimum(x, np.float32(60), out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def gradients(net: Network, before: np.ndarray, target: np.ndarray, drawn: np.ndarray, log_noise: np.ndarray):
    """Slopes of the noise-contrastive loss of a batch, in the order of ``parts``.

    ``log_noise`` is the log probability of each symbol as noise, ``drawn`` the noise symbols of the batch.
    """
    q = net.predicted(before)
    margin = net.bias - log_noise - np.float32(np.log(len(drawn)))
    own, noise = np.take(net.output, target, axis=0), net.output[drawn]
    own_slope = _falling(-(np.einsum("ij,ij->i", q, own) + margin[target])) - 1
    score = q @ -noise.T
    score -= margin[drawn]
    noise_slope = _falling(score)
    q_slope = noise_slope @ noise
    own *= own_slope[:, None]
    q_slope += own
    symbols, rows = np.concatenate([target, drawn]), np.concatenate([own_slope[:, None] * q, noise_slope.T @ q])
    drawn_slope = np.ones(len(target), noise_slope.dtype) @ noise_slope
    bias = np.bincount(symbols, np.concatenate([own_slope, drawn_slope]), len(net.bias)).astype(np.float32)
    # Sums per symbol and place first: the places' weights then apply to few rows.
    q_slope = q_slope.astype(np.float64)
    context = np.zeros_like(net.context)
    places = np.empty_like(net.places)
    for k in range(CONTEXT):
        per_symbol = _summed_rows(before[:, k], q_slope, len(context))
        places[k] = np.einsum("ij,ij->j", per_symbol, net.context)
        per_symbol *= net.places[k]
        context += per_symbol
    return [context, _summed_rows(symbols, rows, len(net.output)), places, bias]


class Trainer:
    """Steps with rates that fall by the slopes met so far, number by number."""

    def __init__(self, net: Network, frequency: np.ndarray, seed: int):
        self.net, self.rng = net, np.random.default_rng(seed)
        self.upto = np.cumsum(frequency)
        self.log_noise = np.log(frequency).astype(np.float32)
        # The network's parts become views of one row of numbers, so that a step is one pass over it.
        self.weights = net.flat()
        net.view(self.weights)
        self.squares = np.full(len(self.weights), 1e-6, np.float32)

    def learn(self, before: np.ndarray, target: np.ndarray) -> None:
        """One pass over the examples in random order."""
        order = self.rng.permutation(len(target))
        # One place's symbols lie side by side.
        before, target = np.ascontiguousarray(before[order].T).T, target[order]
        for start in range(0, len(order), BATCH):
            part = slice(start, start + BATCH)
            size = len(target[part])
            drawn = np.searchsorted(self.upto, self.rng.random(NOISE) * self.upto[-1], "right")
            drawn = np.minimum(drawn, len(self.upto) - 1)
            slopes = gradients(self.net, before[part], target[part], drawn, self.log_noise)
            slope = np.concatenate([s.ravel() for s in slopes])
            slope /= size
            step = slope * slope
            self.squares += step
            np.sqrt(self.squares, out=step)
            slope *= RATE
            slope /= step
            self.weights -= slope
