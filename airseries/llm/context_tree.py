"""Context-tree weighting over bytes: counts of context nodes, their weights and predictions.

A symbol is eight binary decisions. A decision of a symbol has a node: the bits decided before it,
as a number from 1 to 255 with a leading one. A context of depth d is the d bytes before the
symbol, the nearest one first. Node keys are ``context << 8 | node``.
"""

from __future__ import annotations

import dataclasses

import numpy as np

#: Start and end of a text; this byte does not occur in UTF-8.
EDGE = 255


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2 by Stirling's series, shifted up by eight."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def grams(data: np.ndarray, depth: int) -> np.ndarray:
    """For every byte from the ``depth``-th on: its context, nearest byte first, then the byte itself."""
    size = len(data) - depth
    code = np.zeros(size, np.uint64)
    for back in range(1, depth + 1):
        code = (code << np.uint64(8)) | data[depth - back : depth - back + size]
    return (code << np.uint64(8)) | data[depth:]


@dataclasses.dataclass
class Level:
    """Nodes of one depth by sorted key: zeros, ones, log of the weighted probability."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray

    def own_weight(self, deepest: bool) -> np.ndarray:
        """Posterior weight of a node's own estimate against its deeper contexts'."""
        if deepest:
            return np.ones(len(self.keys))
        return np.exp(estimate(self.zeros, self.ones) - np.log(2) - self.weighted)


def grouped(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[begins], *(np.add.reduceat(v[order], begins) if len(keys) else v for v in values)


def deepest_level(codes: np.ndarray, counts: np.ndarray) -> Level:
    """Nodes of the full contexts, from distinct grams and their counts."""
    symbol = codes & np.uint64(255)
    context = (codes >> np.uint64(8)) << np.uint64(8)
    keys, zeros, ones = [], [], []
    for k in range(8):
        bit = (symbol >> np.uint64(7 - k)) & np.uint64(1)
        keys.append(context | (np.uint64(1 << k) | (symbol >> np.uint64(8 - k))))
        zeros.append(np.where(bit == 0, counts, 0).astype(float))
        ones.append(np.where(bit == 1, counts, 0).astype(float))
    keys, zeros, ones = grouped(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))
    return Level(keys, zeros, ones, estimate(zeros, ones))


def parent_sums(level: Level) -> tuple[np.ndarray, ...]:
    """Keys one byte shorter, with the sums of zeros, ones and log weighted probability of their children."""
    node = level.keys & np.uint64(255)
    keys = ((level.keys >> np.uint64(16)) << np.uint64(8)) | node
    return grouped(keys, level.zeros, level.ones, level.weighted)


def mixed(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> Level:
    """Half a node's own estimate and half the product of its children."""
    return Level(keys, zeros, ones, np.logaddexp(estimate(zeros, ones), children) - np.log(2))


def levels_down_to(codes: np.ndarray, counts: np.ndarray, depth: int, least: int) -> list[Level]:
    """Levels from ``depth`` to ``least``; all contexts with the same ``least`` nearest bytes must be there."""
    levels = [deepest_level(codes, counts)]
    for _ in range(depth - least):
        levels.append(mixed(*parent_sums(levels[-1])))
    return levels


def log10_probability(codes: np.ndarray, levels: list[Level], depth: int) -> np.ndarray:
    """Log10 of the symbol's probability after its context, by all ``depth + 1`` levels, deepest first.

    A context that never occurred predicts like the longest of its suffixes that did, and one half
    if none did.
    """
    symbol = codes & np.uint64(255)
    context = codes >> np.uint64(8)
    weights = [level.own_weight(i == 0) for i, level in enumerate(levels)]
    total = np.zeros(len(codes))
    for k in range(8):
        bit = (symbol >> np.uint64(7 - k)) & np.uint64(1)
        node = np.uint64(1 << k) | (symbol >> np.uint64(8 - k))
        chance = np.full(len(codes), np.nan)
        for level, weight, cut in zip(levels, weights, range(depth + 1), strict=True):
            if not len(level.keys):
                continue
            keys = ((context >> np.uint64(8 * cut)) << np.uint64(8)) | node
            at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            known = level.keys[at] == keys
            hits = np.where(bit == 1, level.ones[at], level.zeros[at])
            own = (hits + 0.5) / (level.zeros[at] + level.ones[at] + 1.0)
            deeper = np.where(np.isnan(chance), own, chance)
            chance = np.where(known, weight[at] * own + (1 - weight[at]) * deeper, chance)
        total += np.log10(np.where(np.isnan(chance), 0.5, chance))
    return total
