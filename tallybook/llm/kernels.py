"""Array kernels over UTF-8 text: word hashes, shingles and rolling byte hashes.

Everything here runs inside a task on one Arrow batch.  A hash of bytes ``b`` at
position ``s`` is the polynomial sum of ``b[i] * BASE**(i - s)`` modulo 2**64,
read off one prefix sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j] = sum of (data[i] + 1) * BASE**i for i < j."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hashes of data[start:end] for arrays of bounds."""
    return mix((sums[end] - sums[start]) * powers(BASE_INVERSE, len(sums))[start])


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text stands alone."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield first, i
            first, held = i, 0
        held += len(t)
    if first < len(texts):
        yield first, len(texts)


_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


class Words:
    """The words of some texts: bounds, hashes and the text each belongs to.

    A word is a maximal run of ASCII letters, digits, ``_`` and non-ASCII
    characters of the lower-cased text.  Null texts have no words.
    """

    def __init__(self, texts: list[bytes]):
        self.n_texts = len(texts)
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_end = np.cumsum(lengths)
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = _WORD[data]
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.text_end, self.start, side="right")
        self.data = data
        self.sums = prefix_sums(data)
        self.hash = span_hashes(self.sums, self.start, self.end)
        self.first = np.searchsorted(self.text, np.arange(self.n_texts + 1))

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(hash, text index) of every run of ``size`` words; a shorter text is one shingle."""
        n = len(self.hash)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        weights = [np.uint64(pow(BASE, 2 * j + 3, 1 << 64)) for j in range(size)]
        padded = np.concatenate([self.hash, np.zeros(size, np.uint64)])
        total = np.zeros(n, np.uint64)
        counts = np.diff(self.first)
        left = self.first[1:][self.text] - np.arange(n)
        for j in range(size):
            total += np.where(left > j, padded[j : j + n] * weights[j], np.uint64(0))
        keep = (left >= size) | ((counts[self.text] < size) & (left == counts[self.text]))
        return mix(total[keep]), self.text[keep]


def lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]


def union_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of pairs (a, b) that form a spanning forest over n nodes."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return np.asarray(kept, dtype=np.int64)
