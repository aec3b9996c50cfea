"""Word shingles of whole texts as 64-bit hashes, shared by the operators on near duplicates."""

from __future__ import annotations

import itertools

import numpy as np

from .words import Words, mix

WIDTH = 5
#: A-Z to a-z on UTF-8 bytes, where no other character holds a byte below 128.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_sets(rows: list[bytes]) -> list[np.ndarray]:
    """Each text's set of shingles as sorted distinct hashes; words are what lies between space and bytes 9 to 13.

    A text of fewer than five words has its whole sequence as one shingle, and one without words has none.
    """
    words = Words([t.translate(LOWER) for t in rows])
    hashes = words.hashes()
    n = len(hashes)
    term = hashes.copy()
    for k in range(1, WIDTH):
        term[: max(0, n - k)] = mix(term[: max(0, n - k)] + np.uint64(k)) ^ hashes[k:]
    term = mix(term)
    out = []
    for a, b in itertools.pairwise(words.edges.tolist()):
        if b - a >= WIDTH:
            own = np.sort(term[a : b - WIDTH + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif b > a:
            h = np.uint64(b - a)
            for x in hashes[a:b]:
                h = mix(np.array([h]) ^ x)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
