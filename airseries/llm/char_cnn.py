"""A small convolutional network over characters, in numpy: forward, training, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: Codes of one character: 128 ASCII characters and one for all others, first in the context, then in the candidate.
KINDS = 129
CODES = 2 * KINDS + 1
#: The code of what lies beyond the window.
BLANK = 2 * KINDS
WIDTH, FILTERS, HIDDEN = 5, 32, 16
#: Positions convolved at once; longer windows are worked on in slices that overlap.
SLICE = 4096
#: Codes of the windows that are worked on at once; a longer window is worked on alone.
CELLS = 1 << 16


def encode(window: str, start: int, end: int) -> np.ndarray:
    """Codes of a window whose candidate lies from ``start`` to ``end``."""
    points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.minimum(points, KINDS - 1).astype(np.int16)
    # Keys come in either case.
    codes[(codes >= 65) & (codes <= 90)] += 32
    codes[start:end] += KINDS
    return codes


def without_context(codes: np.ndarray) -> np.ndarray:
    """The candidate alone; its context is blank."""
    return np.where(codes < KINDS, BLANK, codes).astype(codes.dtype)


def padded(windows: list[np.ndarray], length: int | None = None) -> np.ndarray:
    """Windows as rows of one matrix with blanks on both sides.

    WIDTH of them, so a filter sees blanks alone in every row, however long the other windows are.
    """
    length = length or max([1, *map(len, windows)])
    out = np.full((len(windows), length + 2 * WIDTH), BLANK, np.int64)
    for row, codes in zip(out, windows, strict=True):
        row[WIDTH : WIDTH + len(codes)] = codes
    return out


def alike(sizes: Sequence[int], cells: int) -> Iterator[np.ndarray]:
    """Numbers of windows of about the same length that are worked on together, ``cells`` codes at a time."""
    order = np.argsort(sizes, kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and (hi + 1 - lo) * sizes[order[hi]] <= cells:
            hi += 1
        yield order[lo:hi]
        lo = hi


@dataclass
class Network:
    """Convolution by table look-up, the largest response of each filter, a hidden layer, one logit."""

    table: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def random(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        zero = lambda n: np.zeros(n, np.float32)
        return cls(draw(0.1, WIDTH, CODES, FILTERS), zero(FILTERS), draw(0.3, FILTERS, HIDDEN), zero(HIDDEN), draw(0.3, HIDDEN), zero(1))

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Filter responses at every position of a matrix of codes."""
        n = codes.shape[1] - WIDTH + 1
        total = self.table[0][codes[:, :n]]
        for k in range(1, WIDTH):
            total += self.table[k][codes[:, k : k + n]]
        return total

    def strongest(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter and its first place, slice by slice for long windows."""
        n = codes.shape[1] - WIDTH + 1
        best = np.full((len(codes), FILTERS), -np.inf, self.table.dtype)
        at = np.zeros(best.shape, np.int64)
        for lo in range(0, n, SLICE):
            part = self.responses(codes[:, lo : min(lo + SLICE, n) + WIDTH - 1])
            here = part.argmax(axis=1)
            top = np.take_along_axis(part, here[:, None, :], 1)[:, 0]
            at = np.where(top > best, here + lo, at)
            best = np.maximum(best, top)
        return best, at

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """The largest response of each filter, slice by slice for long windows."""
        n = codes.shape[1] - WIDTH + 1
        best = np.full((len(codes), FILTERS), -np.inf, np.float32)
        for lo in range(0, n, SLICE):
            part = self.responses(codes[:, lo : min(lo + SLICE, n) + WIDTH - 1])
            np.maximum(best, part.max(axis=1), out=best)
        return best

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self._top(self.pooled(codes))[2]

    def _top(self, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        active = np.maximum(best + self.bias, 0)
        hidden = np.maximum(active @ self.hidden + self.hidden_bias, 0)
        return active, hidden, hidden @ self.out + self.out_bias[0]

    def gradients(self, codes: np.ndarray, wanted: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of a batch and its gradient in every parameter."""
        best, at = self.strongest(codes)
        active, hidden, logit = self._top(best)
        chance = 1 / (1 + np.exp(-logit))
        slope = (chance - wanted) / len(wanted)
        loss = float(np.mean(np.logaddexp(0, logit) - wanted * logit))
        d_hidden = np.outer(slope, self.out) * (hidden > 0)
        d_active = (d_hidden @ self.hidden.T) * (active > 0)
        d_table = np.zeros_like(self.table)
        filters = np.broadcast_to(np.arange(FILTERS), at.shape)
        rows = np.arange(len(codes))[:, None]
        for k in range(WIDTH):
            np.add.at(d_table[k], (codes[rows, at + k], filters), d_active)
        return loss, [d_table, d_active.sum(0), active.T @ d_hidden, d_hidden.sum(0), hidden.T @ slope, slope.sum(keepdims=True)]


@dataclass
class Learner:
    """A network under training by Adam, with both moments of its slopes and the number of steps taken."""

    network: Network
    first: list[np.ndarray]
    second: list[np.ndarray]
    step: float

    @classmethod
    def fresh(cls, seed: int = 1) -> Learner:
        network = Network.random(seed)
        return cls(network, *[[np.zeros_like(p) for p in network.parameters()] for _ in range(2)], 0.0)

    def vector(self) -> np.ndarray:
        """All its numbers in a row; learners from the same start can be averaged so."""
        arrays = [*self.network.parameters(), *self.first, *self.second, np.array([self.step])]
        return np.concatenate([a.ravel() for a in arrays]).astype(np.float32)

    @classmethod
    def of(cls, vector: np.ndarray) -> Learner:
        learner, at = cls.fresh(), 0
        for array in [*learner.network.parameters(), *learner.first, *learner.second]:
            array[...] = vector[at : at + array.size].reshape(array.shape)
            at += array.size
        learner.step = float(vector[at])
        return learner

    def epoch(self, windows: Sequence[np.ndarray], wanted: np.ndarray, rng: np.random.Generator, batch: int = 64) -> None:
        """Every window once with its context and once without, in random order."""
        order = rng.permutation(2 * len(windows))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            chosen = [windows[i] if i < len(windows) else without_context(windows[i - len(windows)]) for i in some]
            target = wanted[some % len(windows)].astype(np.float32)
            self._adam(self._slopes(chosen, target))

    def _slopes(self, windows: list[np.ndarray], wanted: np.ndarray) -> list[np.ndarray]:
        total = [np.zeros_like(p) for p in self.network.parameters()]
        for some in alike([len(w) for w in windows], CELLS):
            share = len(some) / len(windows)
            slopes = self.network.gradients(padded([windows[i] for i in some]), wanted[some])[1]
            for t, g in zip(total, slopes, strict=True):
                t += share * g
        return total

    def _adam(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for p, g, m, v in zip(self.network.parameters(), slopes, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.003 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def all_logits(network: Network, windows: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """Logits of windows of any length; those of about the same length go together, ``cells`` codes at a time."""
    out = np.zeros(len(windows), np.float32)
    for some in alike([len(w) for w in windows], cells):
        out[some] = network.logits(padded([windows[i] for i in some]))
    return out


def targets(positive: float, negative: float) -> tuple[float, float]:
    """Platt's targets for findings and others."""
    return (positive + 1) / (positive + 2), 1 / (negative + 2)


def platt(sums: Callable[[float, float], Sequence[float]], rounds: int = 200) -> tuple[float, float]:
    """Slope and offset that turn logits into probabilities, by Newton's steps.

    ``sums`` gives, for a slope and an offset, the sums over all logits x of (chance - target) x, chance - target, and of
    chance (1 - chance) times x x, x and 1.
    """
    weights = np.array([1.0, 0.0])
    for _ in range(rounds):
        gx, g, xx, x, one = sums(float(weights[0]), float(weights[1]))
        slope = np.array([gx, g]) + 1e-3 * (weights - [1.0, 0.0])
        curve = np.array([[xx, x], [x, one]]) + 1e-3 * np.eye(2)
        change = np.linalg.solve(curve, slope)
        weights = weights - change * min(1.0, 1.0 / max(1e-12, np.abs(change).max()))
        if np.abs(change).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def calibrated(logits: np.ndarray, wanted: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and offset of logits that are all at hand; see :func:`platt`."""
    found, other = targets(wanted.sum(), (1 - wanted).sum())
    target, x = np.where(wanted > 0, found, other), logits.astype(float)

    def sums(slope: float, offset: float) -> Sequence[float]:
        chance = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        curve = chance * (1 - chance)
        return ((chance - target) @ x, (chance - target).sum(), curve @ x**2, curve @ x, curve.sum())

    return platt(sums, rounds)


def threshold_for(chances: np.ndarray, wanted: np.ndarray, recall: float) -> float:
    """The highest threshold at which at least ``recall`` of the findings are found."""
    found = np.sort(chances[wanted > 0])[::-1]
    return float(found[max(0, int(np.ceil(recall * len(found))) - 1)]) if len(found) else 1.0
