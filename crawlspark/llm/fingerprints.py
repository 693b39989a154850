"""Numpy fingerprints of byte and word sequences, for use inside tasks."""

import numpy as np

_U = np.uint64
# Two families of polynomial hashes modulo 2^64, so that a pair of fingerprints counts as 128 bits.
BASES = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))
_VALUES = [np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64) for seed in (11, 12)]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_powers: dict = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def powers(family: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a family's base and of its inverse modulo 2^64, at least `count`."""
    known = _powers.get(family)
    if known is None or len(known[0]) < count:
        size = 1 << max(12, int(count - 1).bit_length())
        base = int(BASES[family])
        steps = np.full((2, size), 1, np.uint64)
        steps[0, 1:], steps[1, 1:] = BASES[family], _U(pow(base, -1, 1 << 64))
        known = _powers[family] = tuple(np.cumprod(steps, axis=1))
    return known[0][:count], known[1][:count]


class Sequence:
    """Hashes of stretches of a sequence of 64-bit items, equal wherever the items are equal."""

    def __init__(self, items: np.ndarray, family: int):
        up, self.down = powers(family, len(items) + 1)
        self.sums = np.zeros(len(items) + 1, np.uint64)
        np.cumsum(items * up[:-1], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts]
                   + (ends - starts).astype(np.uint64) * _U(0xA24BAED4963EE407))


def byte_items(codes: np.ndarray, family: int) -> np.ndarray:
    return _VALUES[family][codes]


def word_bounds(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in UTF-8 bytes."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.diff(np.r_[True, _BLANK[codes], True].astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def word_items(codes: np.ndarray, family: int) -> np.ndarray:
    """A 64-bit fingerprint of every word of a text."""
    starts, ends = word_bounds(codes)
    piece, found = 1 << 16, []
    # Words are hashed in pieces, so that a very long text needs no arrays of its own length.
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + piece)))
        low, high = starts[first], ends[last - 1]
        hashed = Sequence(byte_items(codes[low:high], family), family)
        found.append(hashed.hashes(starts[first:last] - low, ends[first:last] - low))
        first = last
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbouring values: running minima forwards and backwards within blocks."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1:width - 1 + count])
