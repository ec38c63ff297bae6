"""Sets of hashed word shingles of whole texts, by numpy over many texts at once.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  A
text's set holds its distinct runs of ``SHINGLE`` words; a shorter text is one
shingle of all its words; a text without words has an empty set.  A shingle is
a 64-bit hash: words by a rolling polynomial over their bytes, runs by a mix of
their words' hashes.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = [(0xD6E8FEB86659FD93 * (2 * j + 3)) & (2**64 - 1) | 1 for j in range(SHINGLE)]
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: list[np.ndarray] = []
KEPT_POWERS = 1 << 20  # entries of the tables that stay in a worker


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            steps = [np.full(n, b, np.uint64) for b in (_BASE, _INVERSE)]
            for s in steps:
                s[0] = 1
            _powers[:] = [np.cumprod(s, dtype=np.uint64) for s in steps]
    return _powers


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raws = [t.encode("utf-8", "replace").lower() for t in texts]
    sizes = np.array([len(r) + 1 for r in raws])
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    white = _WHITE[data]
    edge = np.flatnonzero(np.diff(white, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    power, inverse = _power_tables(max(1 << 18, len(data)))
    with np.errstate(over="ignore"):
        sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], dtype=np.uint64)
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        words = mix((sums[ends - 1] - before) * inverse[starts] + (ends - starts).astype(np.uint64))
        runs = np.zeros(len(words), np.uint64)
        for j, place in enumerate(_PLACE):
            runs[:max(0, len(words) - j)] += words[j:] * np.uint64(place)
        runs = mix(runs)
        text_of = np.searchsorted(np.cumsum(sizes) - sizes, starts, "right") - 1
        bounds = np.searchsorted(text_of, np.arange(len(texts) + 1))
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= SHINGLE:
                out.append(np.unique(runs[a:b - SHINGLE + 1]))
            elif b > a:  # all words as one, told apart by their number
                whole = sum((int(w) * p for w, p in zip(words[a:b], _PLACE)), b - a) & (2**64 - 1)
                out.append(mix(np.array([whole ^ 0xA5A5A5A5A5A5A5A5], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    if len(power) > KEPT_POWERS:  # made for one very long text
        _powers.clear()
    return out
