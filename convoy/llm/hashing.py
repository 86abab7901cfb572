"""Word and shingle hashes over flat text buffers, a whole block of text at a time."""

from __future__ import annotations

import numpy as np

_U = np.uint64
# An odd multiplier has an inverse modulo 2**64, so that hashes of substrings can be shifted.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Everything in ASCII but digits and letters stands between words.
MARKS = np.ones(256, bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse, kept for the next call."""
    held = len(_tables.get("up", ()))
    if held < n:
        size = max(n, 2 * held, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"][:n], _tables["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = base**i times the polynomial hash of data[i:j]."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of data[start:end], independent of where they stand."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE, head: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of every text, and the offsets of each text's words.

    Words are runs of anything but ASCII white space, or but the bytes marked in
    ``gaps``; A-Z is lower-cased. With ``head`` only a word's first bytes count. The
    buffer is worked through in blocks that end at white space or between texts,
    so one very long text needs no more memory than many short ones.
    """
    total = len(data)
    hashes, starts = [], []
    at = 0
    while at < total:
        end = min(at + BLOCK, total)
        if end < total:
            end = _cut(data, offsets, at, end)
        block = _LOWER[data[at:end]]
        word = ~gaps[block]
        first = word.copy()
        first[1:] &= ~word[:-1]
        edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        first[edges] |= word[edges]
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        stop = stop if head is None else np.minimum(stop, begin + head)
        hashes.append(mix(spans_hash(prefix_hashes(block), begin, stop)))
        starts.append(begin + at)
        at = end
    if not hashes:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def _cut(data: np.ndarray, offsets: np.ndarray, at: int, end: int) -> int:
    """The last place in (at, end] where no word is cut, or else the first after it."""
    edge = offsets[np.searchsorted(offsets, end, side="right") - 1]
    spaces = np.flatnonzero(_SPACE[data[at + 1 : end]])
    best = max(int(edge), at + 1 + int(spaces[-1]) if len(spaces) else 0)
    if best > at:
        return best
    while end < len(data):
        spaces = np.flatnonzero(_SPACE[data[end : end + BLOCK]])
        edge = offsets[np.searchsorted(offsets, end)]
        stop = min(int(edge), end + int(spaces[0]) if len(spaces) else len(data))
        if stop < end + BLOCK:
            return stop
        end += BLOCK
    return len(data)


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words within a text, and their offsets.

    A text with fewer words gives its whole sequence as one; without words, none.
    """
    n_words = np.diff(bounds)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    ends = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(ends[-1], _U)
    if len(words) >= size:
        runs = np.zeros(len(words) - size + 1, _U)
        for k in range(size):
            runs += words[k : len(words) - size + 1 + k] * _U(pow(BASE, 2 * k + 1, 1 << 64))
        long = np.flatnonzero(n_words >= size)
        text = np.repeat(long, counts[long])
        within = np.arange(len(text)) - np.repeat(np.cumsum(counts[long]) - counts[long], counts[long])
        out[ends[text] + within] = runs[bounds[text] + within]
    for d in np.flatnonzero((n_words > 0) & (n_words < size)):
        some = words[bounds[d] : bounds[d + 1]]
        scaled = some * np.array([pow(BASE, 2 * k + 1, 1 << 64) for k in range(len(some))], _U)
        out[ends[d]] = scaled.sum(dtype=_U) + _U(len(some))
    return mix(out), ends


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    hashes, ends = shingle_hashes(*word_hashes(data, offsets), size)
    return [_distinct(hashes[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]
