"""Words of texts as arrays: positions and 64-bit hashes, computed with numpy over many documents at once.

A word is a maximal run of bytes other than the six ASCII spaces, which in
UTF-8 is the same as a run of such characters. Documents are handled in chunks
of about CHUNK_BYTES; only a longer document makes a longer chunk.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK_BYTES = 1 << 20
_BLOCK = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) | np.uint64(1)


_LETTERS = constants(256, 7)
_BASE = int(constants(1, 11)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = (_powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK))


def chunks(rows: Iterable[tuple], size: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Lists of rows whose first field (bytes) together are about `size` long."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[0]) + 1
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One byte array with a line break between texts, and where each text starts (one more entry at the end)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    space = np.concatenate([[True], _SPACE[data], [True]])
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[0::2], change[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of letter codes times powers of an odd base."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        upto = max(at + 1, int(np.searchsorted(ends, first + _BLOCK - 1, "right")))
        n = int(ends[upto - 1]) - first
        up, down = _POWERS if n < _BLOCK else (_powers(_BASE, n + 1), _powers(_INVERSE, n + 1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[data[first:first + n]] * up[:n], out=sums[1:])
        s, e = starts[at:upto] - first, ends[at:upto] - first
        out[at:upto] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = upto
    return out


def gram_hashes(words: np.ndarray, n: int, seed: int = 23) -> np.ndarray:
    """Hashes of all n consecutive words (fewer by n - 1 than words, none if there are fewer)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    c = constants(n, seed)
    m = len(words) - n + 1
    total = words[:m] * c[0]
    for k in range(1, n):
        total += words[k:m + k] * c[k]
    return mix(total)


class Words:
    """The words of a chunk of texts: hashes, bounds in `data`, and for each text the range of its words."""

    def __init__(self, texts: list[bytes]):
        self.data, self.offsets = join_texts(texts)
        self.starts, self.ends = word_bounds(self.data)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def grams(self, n: int, seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n-word windows that lie in one text, and for each text the range of its windows."""
        counts = np.maximum(np.diff(self.bounds) - n + 1, 0)
        ranges = np.concatenate([[0], np.cumsum(counts)])
        every = gram_hashes(self.hashes, n, seed)
        first = np.repeat(self.bounds[:-1] - ranges[:-1], counts) + np.arange(ranges[-1])
        return every[first], ranges


def spread(marks: np.ndarray, length: int) -> np.ndarray:
    """Marks of window starts to marks of all positions that a marked window of this length covers."""
    steps = np.zeros(len(marks) + length + 1, np.int32)
    at = np.flatnonzero(marks)
    steps[at] += 1
    np.add.at(steps, at + length, -1)
    return np.cumsum(steps)[: len(marks) + length - 1] > 0
