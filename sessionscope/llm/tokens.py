"""Words of many texts at once, as arrays of 64-bit fingerprints.

A word is a maximal run of bytes other than ASCII white space (0x20 and
0x09-0x0D). Fingerprints are polynomial hashes taken from prefix sums, so the
work per byte is a few array operations. Texts are read in pieces of a few
megabytes, which bounds the memory whatever a text's length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
PIECE = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, and powers of the base and of its inverse."""
    values = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
    powers = []
    for base in (_BASE, _INVERSE):
        p = np.ones(PIECE + 1, np.uint64)
        k = 1
        while k <= PIECE:
            m = min(k, PIECE + 1 - k)
            p[k:k + m] = p[:m] * np.uint64(pow(base, k, 1 << 64))
            k += m
        powers.append(p)
    return values, *powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted (by sorting: faster on hashes than ``np.unique``'s table)."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def places(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where in sorted ``values`` each of many unsorted ``wanted`` is: looked up in order, for the cache's sake."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), np.int64)
    out[order] = np.searchsorted(values, wanted[order])
    return out


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a piece (at most PIECE bytes), for ``span_hashes``."""
    values, powers, _ = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end); equal bytes hash alike anywhere."""
    return (sums[ends] - sums[starts]) * _tables()[2][starts]


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of byte spans in order, however long ``data`` is."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        lo = int(starts[at])
        upto = max(int(np.searchsorted(ends, lo + PIECE, "right")), at + 1)
        if ends[at] - lo > PIECE:
            found: list = []
            _long_word(data[:ends[at]], lo, found)
            out[at] = found[0][0][0]
        else:
            out[at:upto] = span_hashes(prefix_hashes(data[lo:ends[upto - 1]]), starts[at:upto] - lo, ends[at:upto] - lo)
        at = upto
    return mix(out)


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate(([True], _SPACE[data], [True])).view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    return span_hashes(prefix_hashes(data), starts, ends), starts, ends


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, start, end) of each word of ``data``; offsets in bytes."""
    array = np.frombuffer(data, np.uint8)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(array):
        piece = array[at:at + PIECE]
        if at + PIECE < len(array):
            spaces = np.flatnonzero(_SPACE[piece])
            if not len(spaces):  # a word longer than a piece
                at = _long_word(array, at, found)
                continue
            piece = piece[:spaces[-1] + 1]
        h, s, e = _piece_words(piece)
        found.append((h, s + at, e + at))
        at += len(piece)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h, s, e = (np.concatenate(x) for x in zip(*found))
    return mix(h), s, e


def _long_word(array: np.ndarray, start: int, found: list) -> int:
    """Hash the word at ``start`` piece by piece; returns its end."""
    total, weight, at = 0, 1, start
    while at < len(array):
        piece = array[at:at + PIECE]
        spaces = np.flatnonzero(_SPACE[piece])
        piece = piece[:spaces[0]] if len(spaces) else piece
        total += weight * int(prefix_hashes(piece)[-1])
        weight = weight * pow(_BASE, len(piece), 1 << 64) % (1 << 64)
        at += len(piece)
        if len(spaces):
            break
    found.append((np.array([total % (1 << 64)], np.uint64), np.array([start]), np.array([at])))
    return at


def word_windows(h: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of every ``size`` consecutive words' sequence."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    n = len(h) - size + 1
    out = h[:n].copy()
    for k in range(1, size):
        out *= np.uint64(_BASE)
        out += h[k:k + n]
    return mix(out)


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts joined by line ends, and where each begins."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return b"\n".join(texts), starts[:-1]
