"""Words of many texts at once, as NumPy arrays: where they are, and a 64-bit hash of each.

A word is what lies between spaces and bytes 9 to 13. No Python object is made per word.
"""

from __future__ import annotations

import hashlib

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG = 256  # longer words are digested one by one
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multiplications)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: ``starts`` and ``sizes`` in ``raw``, and ``edges``, the number of words before each text."""

    def __init__(self, rows: list[bytes]):
        self.raw = b"\n".join([*rows, bytes(8)])
        data = np.frombuffer(self.raw, np.uint8)
        inside = np.r_[False, ~SPACE[data[:-8]], False]
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts = turns[::2]
        self.sizes = turns[1::2] - self.starts
        ends = np.cumsum([len(r) + 1 for r in rows])
        self.edges = np.r_[0, np.searchsorted(self.starts, ends)]
        self._eight = np.ndarray((len(data) - 7,), "<u8", self.raw, strides=(1,))

    def _part(self, which: np.ndarray, at: int) -> np.ndarray:
        """Eight bytes of some words behind their first ``at``, zero beyond their ends."""
        return self._eight[self.starts[which] + at] & FIRST_BYTES[np.minimum(self.sizes[which] - at, 8)]

    def hashes(self) -> np.ndarray:
        """Words of at most eight bytes and equal length differ in their hash if they differ at all."""
        every = np.arange(len(self.starts))
        out = mix(self._part(every, 0)) + self.sizes.astype(np.uint64)
        at, left = 8, np.flatnonzero((self.sizes > 8) & (self.sizes <= LONG))
        while len(left):
            out[left] = mix(out[left] + self._part(left, at) * np.uint64(0x9E3779B97F4A7C15))
            at += 8
            left = left[self.sizes[left] > at]
        for k in np.flatnonzero(self.sizes > LONG).tolist():
            a = int(self.starts[k])
            digest = hashlib.blake2b(self.raw[a : a + int(self.sizes[k])], digest_size=8).digest()
            out[k] = np.frombuffer(digest, "<u8")[0]
        return mix(out)
