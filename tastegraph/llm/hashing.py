"""64-bit hashes of words and byte ranges over many texts at once (numpy).

A range of bytes hashes to a polynomial in an odd base modulo 2^64 over
random values of its bytes, taken as a difference of running sums, so every
range of a buffer costs the same; a final mix spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(seed: int, n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 32)) * U64(0x9E3779B97F4A7C15))


_LANES: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _lane(seed: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte values, powers and inverse powers of the base for ``size`` bytes
    at least; a process keeps the largest of each seed."""
    if seed in _LANES and len(_LANES[seed][1]) >= size:
        return _LANES[seed]
    bits = max(16, size.bit_length())
    base = int(constants(seed, 1)[0]) & ~7 | 5
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(1 << bits, base, U64), np.full(1 << bits, inverse, U64)
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    _LANES[seed] = constants(seed + 1, 256), up, down
    return _LANES[seed]


class RangeHash:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray, seed: int = 11):
        values, up, self._down = _lane(seed, len(data) + 1)
        self._sums = np.empty(len(data) + 1, U64)
        self._sums[0] = 0
        np.cumsum(values[data] * up[:len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(h + (end - start).astype(U64))


_FOLD = bytes.maketrans(bytes([*range(65, 91), *range(9, 14)]), bytes([*range(97, 123), *[32] * 5]))


def chunks(items: list, sizes: list[int], most: int) -> Iterator[list]:
    """Runs of items of about ``most`` in all; a larger item is alone."""
    held, total = [], 0
    for item, n in zip(items, sizes):
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each UTF-8
    text, A-Z lower-cased, words parted by ASCII white space.  A text with
    fewer words has its whole sequence as one; one without words has none."""
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_FOLD), np.uint8)
    space = data == 32
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(starts, first)
    if not len(starts):
        return [np.empty(0, U64)] * len(texts)
    h = RangeHash(data)(starts, ends)
    factors = constants(23, words)
    padded = np.concatenate([h, np.zeros(words, U64)])
    rolled = sum((padded[j:j + len(h)] * factors[j] for j in range(words)), np.zeros(len(h), U64))
    rolled = mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            out.append(mix((h[a:b] * factors[:b - a]).sum(keepdims=True) + U64(b - a)))
        else:
            out.append(np.empty(0, U64))
    return out
