"""Hashes of words and windows for whole batches of texts at a time, with numpy."""

from __future__ import annotations

import numpy as np

from modelwatch.llm.common import splitmix

#: ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of letters: a-z, A-Z and all of a character beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True

_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, np.uint64)
        if n:
            out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Polynomial hashes, modulo 2^64, of any slice of a sequence of 64-bit symbols; finished by a mixing step.

    ``salt`` gives independent hashes. Symbols are mixed first, so that the polynomial sees no structure in them.
    """

    def __init__(self, symbols: np.ndarray, salt: int = 0):
        n = len(symbols)
        base = _BASE + 2 * salt * 0x5851F42D4C957F2D & (1 << 64) - 1 | 1
        base = base & ~7 | 5  # of the largest order modulo 2^64
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            mixed = splitmix(symbols + np.uint64((salt + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            mixed *= _powers(base, n)
            np.cumsum(mixed, out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, in order of their starts."""
        with np.errstate(over="ignore"):
            out = self.sums[length:] - self.sums[:-length]
            out *= self.inverse[: len(out)]
            out += np.uint64(length)
            return splitmix(out)

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return splitmix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def byte_symbols(salt: int = 0) -> np.ndarray:
    """A 64-bit symbol for each byte value."""
    return splitmix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * salt))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of the runs of bytes where the table ``inside`` holds; no run crosses documents."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    own = inside[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.r_[False, own[:-1]] & ~first[:-1]
    starts = np.flatnonzero(own & ~before)
    after = np.r_[own[1:], False] & ~first[1:]
    ends = np.flatnonzero(own & ~after) + 1
    document = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, document


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is faster here than numpy's hash-based unique."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values
