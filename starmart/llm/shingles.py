"""Word shingles of whole texts as 64-bit hashes, computed in numpy over blocks.

Words are runs of anything but blanks (space, tab to carriage return) with A-Z in
lower case. A shingle is ``k`` words in a row; a text of fewer words is one
shingle by itself; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once in a worker (a longer text is a block by itself).
BLOCK_BYTES = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                   0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose every output bit hangs on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base, base^2, ... base^n modulo 2^64."""
    if len(_TABLES.get(base, ())) < n:
        _TABLES[base] = np.cumprod(np.full(max(n, BLOCK_BYTES + 64), base, np.uint64))
    return _TABLES[base][:n]


def word_hashes(data: np.ndarray, cuts: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts data[cuts[i]:cuts[i+1]], and for each text
    the number of words before it."""
    data = _LOWER[data]
    inside = _WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = cuts[:-1][(cuts[:-1] < len(data))]
    begins[at] = inside[at]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    at = cuts[1:][cuts[1:] > 0] - 1
    ends[at] = inside[at]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    n = len(data)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=sums[1:])
    words = (sums[last] - sums[first]) * _powers(_INVERSE, n)[first]
    words = mixed(words ^ mixed((last - first).astype(np.uint64) + np.uint64(seed)))
    return words, np.searchsorted(first, cuts)


def shingle_sets(texts: pa.Array, k: int = 5, seed: int = 0) -> Iterator[np.ndarray]:
    """For each text in order its distinct shingle hashes, ascending."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")) - at)
        block = texts.slice(at, n)
        cuts = np.frombuffer(block.buffers()[1], np.int64)[block.offset : block.offset + n + 1]
        data = np.frombuffer(block.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        words, before = word_hashes(data, cuts - cuts[0], seed)
        rows = np.zeros(max(0, len(words) - k + 1), np.uint64)
        for i in range(k):
            rows += words[i : i + len(rows)] * _STEPS[i]
        rows = mixed(rows)
        for a, b in zip(before.tolist(), before[1:].tolist()):
            if b - a >= k:
                yield np.unique(rows[a : b - k + 1])
            elif b > a:
                yield mixed((words[a:b] * _STEPS[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
        at += n
