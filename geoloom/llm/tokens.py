"""Words of many texts at once, on UTF-8 bytes: places and 64-bit hashes of all runs without ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes that one slice of texts has, about; a longer text is a slice of its own.
SLICE = 1 << 20

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1 << 62, (1 << 64) - 1, 256, np.uint64, endpoint=True) | np.uint64(1)
_LOWERED = _VALUES[[c + 32 if 65 <= c <= 90 else c for c in range(256)]]
_BASE = int(_rng.integers(1 << 60, 1 << 62)) | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different values of a, ascending; which of them each value is; an order that sorts a, and where each value's run begins in it."""
    order = np.argsort(a)
    s = a[order]
    new = np.ones(len(a), bool)
    new[1:] = s[1:] != s[:-1]
    back = np.empty(len(a), np.int64)
    back[order] = np.cumsum(new) - 1
    return s[new], back, order, np.flatnonzero(new)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    size = max(SLICE + 1, 1 << max(0, n).bit_length())
    if size not in _powers:
        _powers.clear()

        def table(b: int) -> np.ndarray:
            out = np.ones(size, np.uint64)
            done, step = 1, b
            while done < size:
                out[done : 2 * done] = out[: min(done, size - done)] * np.uint64(step)
                step, done = step * step % (1 << 64), 2 * done
            return out

        _powers[size] = table(_BASE), table(_INVERSE)
    return _powers[size]


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte range of buf: equal ranges anywhere have equal hashes. lower: A-Z count as a-z."""
    up, down = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_LOWERED if lower else _VALUES)[buf] * up[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of buf."""
    on = np.concatenate(([False], ~SPACE[buf], [False]))
    edge = np.flatnonzero(on[1:] != on[:-1])
    return edge[::2], edge[1::2]


def grouped(texts: list[bytes], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together."""
    lo = total = 0
    for i, t in enumerate(texts):
        if i > lo and total + len(t) > size:
            yield lo, i
            lo, total = i, 0
        total += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def owners(texts: list[bytes], lo: int, hi: int) -> np.ndarray:
    """The text (counted from lo) of each byte of a slice; the space after a text belongs to it."""
    return np.repeat(np.arange(hi - lo), [len(t) + 1 for t in texts[lo:hi]])


def slices(texts: list[bytes], lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of texts as (first, last + 1, bytes with a space after each text, word starts, word ends, text of each word counted from first, word hashes)."""
    for lo, hi in grouped(texts):
        buf = np.frombuffer(b"".join(x for t in texts[lo:hi] for x in (t, b" ")), np.uint8)
        starts, ends = spans(buf)
        edges = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        yield lo, hi, buf, starts, ends, np.searchsorted(edges, starts, side="right"), hashes(buf, starts, ends, lower)


def repeated(h: np.ndarray, doc: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each of n texts, the words inside windows of `size` words that its text has twice or more."""
    if len(h) < size:
        return np.zeros(n, np.int64)
    m = len(h) - size + 1
    key = mix(doc[:m].astype(np.uint64) + np.uint64(1))
    for i in range(size):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + h[i : i + m])
    own = np.flatnonzero(doc[:m] == doc[size - 1 :])
    _, back, times = np.unique(key[own], return_inverse=True, return_counts=True)
    hit = own[times[back] > 1]
    on = np.zeros(len(h), bool)
    for i in range(size):
        on[hit + i] = True
    return np.bincount(doc[on], minlength=n)
