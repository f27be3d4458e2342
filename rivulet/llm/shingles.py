"""Vectorised words, shingle sets and minima over Arrow batches of texts."""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(np.random.PCG64(1009))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BYTE[_SPACE] = 0
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_POWER = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
_STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
#: Bytes of text that are hashed at a time; a longer text is alone in its group.
GROUP = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column without copying; null is empty."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, at, data = column.buffers()
    at = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def groups(at: np.ndarray, most: int = GROUP):
    """(first, last) rows of consecutive groups of about ``most`` bytes."""
    n, first = len(at) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def word_hashes(data: np.ndarray, at: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, words before each text) for texts data[at[i]:at[i+1]]."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    solid = ~_SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    edge = at[:-1][at[:-1] < at[1:]]
    start[edge] = solid[edge]
    places = np.flatnonzero(start)
    before = np.searchsorted(places, at)
    if not len(places):
        return np.zeros(0, np.uint64), before
    value = (_FOLDED if fold else _BYTE)[data]
    value[: places[0]] = 0
    inside = np.arange(len(data), dtype=np.int32)
    inside[places[0] :] -= np.repeat(places.astype(np.int32), np.diff(np.append(places, len(data))))
    far = inside >= len(_POWER)
    if far.any():
        value = np.where(far, mix(value + inside.astype(np.uint64)), value)
        inside = np.where(far, 0, inside)
    value *= _POWER[inside]
    value[~solid] = 0
    return mix(np.add.reduceat(value, places)), before


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner) of the distinct ``width``-word shingles of each text, sorted by owner, then hash.

    Words fold A-Z; a text with fewer words has its whole sequence as its one shingle, a text
    without words none.
    """
    words, before = word_hashes(data, at, True)
    count = np.diff(before)
    owner = np.repeat(np.arange(len(count), dtype=np.int64), count)
    left = np.repeat(before[1:], count) - np.arange(len(words))  # words from here to the text's end
    first = np.arange(len(words)) == np.repeat(before[:-1], count)
    keep = np.flatnonzero((left >= width) | first)
    length = np.minimum(left[keep], width)
    h = np.zeros(len(keep), np.uint64)
    for k in range(width):
        has = length > k
        w = np.zeros(len(keep), np.uint64)
        w[has] = words[keep[has] + k] * _STEP[k]
        h += w
    h = mix(h + length.astype(np.uint64) * _STEP[63])
    owner = owner[keep]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def minima(h: np.ndarray, owner: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(n, len(a)) minima of the universal hashes a * x + b over each owner's set; owners without a set get the largest value."""
    out = np.full((n, len(a)), np.iinfo(np.uint64).max, np.uint64)
    if not len(h):
        return out
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    who = owner[starts]
    ends = np.append(starts[1:], len(h))
    lo = 0
    while lo < len(starts):  # pieces that stay in the cache
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 32_768, "right")))
        x, s = h[starts[lo] : ends[hi - 1]], starts[lo:hi] - starts[lo]
        y = np.empty_like(x)
        for j in range(len(a)):
            np.multiply(x, a[j], out=y)
            y += b[j]
            out[who[lo:hi], j] = np.minimum.reduceat(y, s)
        lo = hi
    return out
