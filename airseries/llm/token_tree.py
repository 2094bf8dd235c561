"""A segment tree over the pieces of a text, with bytes and tokens summed in every subtree."""

from __future__ import annotations

import numpy as np


def piece_starts(text: bytes) -> np.ndarray:
    """Where pieces begin: at 0 and at every space after a printable ASCII character.

    A pre-token never spans such a place, and what lies on one side never changes the
    tokens of the other, so each piece can be encoded by itself.
    """
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    cut = np.flatnonzero((data[1:] == 32) & (data[:-1] > 32) & (data[:-1] < 127)) + 1
    return np.concatenate([[0], cut]).astype(np.int64)


def _levels(leaves: np.ndarray) -> list[np.ndarray]:
    """Sums of pairs, of pairs of pairs and so on; each level but the root has an even length."""
    levels = [leaves.astype(np.int64)]
    while len(levels[-1]) > 1:
        if len(levels[-1]) % 2:
            levels[-1] = np.append(levels[-1], 0)
        levels.append(levels[-1][::2] + levels[-1][1::2])
    return levels


class TokenTree:
    """Leaves are pieces in order; a leaf that was edited holds the pieces that came in its place."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray) -> None:
        self.n_leaves = len(sizes)
        self.bytes = _levels(sizes)
        self.tokens = _levels(counts)
        self.inner: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @property
    def n_bytes(self) -> int:
        return int(self.bytes[-1].sum())

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[-1].sum())

    def find(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaves that hold the bytes at ``places``, and their starts; at the end, one past the last leaf."""
        leaf, start = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        inside = np.minimum(places, self.n_bytes - 1)
        for level in reversed(self.bytes[:-1]):
            leaf *= 2
            left = level[leaf]
            right = inside >= start + left
            start += np.where(right, left, 0)
            leaf += right
        end = places >= self.n_bytes
        return np.where(end, self.n_leaves, leaf), np.where(end, self.n_bytes, start)

    def replace(self, regions: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        """For each (first, last, sizes, counts): these pieces in the place of leaves first to last - 1.

        Regions do not meet. Sums change along the paths of their leaves only.
        """
        if not self.n_leaves:
            for _, _, sizes, counts in regions:
                self.__init__(sizes, counts)
            return
        for first, last, sizes, counts in regions:
            for leaf in range(first, last):
                self.inner.pop(leaf, None)
            self.inner[first] = (sizes, counts)
            self.bytes[0][first:last] = 0
            self.tokens[0][first:last] = 0
            self.bytes[0][first] = sizes.sum()
            self.tokens[0][first] = counts.sum()
        touched = np.concatenate([np.arange(first, last) for first, last, *_ in regions])
        for depth in range(1, len(self.bytes)):
            touched = np.unique(touched // 2)
            for levels in (self.bytes, self.tokens):
                below = levels[depth - 1]
                levels[depth][touched] = below[2 * touched] + below[2 * touched + 1]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of all pieces, edited ones included, in order."""
        sizes, counts, at = [], [], 0
        for leaf, own in sorted(self.inner.items()):
            sizes += [self.bytes[0][at:leaf], own[0]]
            counts += [self.tokens[0][at:leaf], own[1]]
            at = leaf + 1
        sizes, counts = np.concatenate([*sizes, self.bytes[0][at:]]), np.concatenate([*counts, self.tokens[0][at:]])
        kept = sizes > 0
        return sizes[kept], counts[kept]

    def pack(self) -> bytes:
        """The leaves as bytes, one per number unless one is above 255; inner sums follow from them."""
        return pack_leaves(*self.leaves())

    @classmethod
    def unpack(cls, packed: bytes) -> TokenTree:
        both = np.frombuffer(packed, np.uint32 if packed[0] else np.uint8, offset=1)
        return cls(both[: len(both) // 2], both[len(both) // 2 :])


def pack_leaves(sizes: np.ndarray, counts: np.ndarray) -> bytes:
    wide = max(sizes.max(initial=0), counts.max(initial=0)) > 255
    return bytes([int(wide)]) + np.concatenate([sizes, counts]).astype(np.uint32 if wide else np.uint8).tobytes()
