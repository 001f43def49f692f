"""Sets of hashed word n-grams of texts, computed on the bytes of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_WINDOW = 1 << 18
_SLICE_BYTES = 1 << 20


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, dtype=np.uint64)]), dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15
_UP = _powers(_BASE, _WINDOW + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), _WINDOW + 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]


def _cuts(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Windows of the bytes that end between words."""
    at, end = int(bounds[0]), int(bounds[-1])
    while at < end:
        stop = min(at + _WINDOW, end)
        if stop < end:
            text_end = int(bounds[np.searchsorted(bounds, stop, side="right") - 1])
            spaces = np.flatnonzero(_SPACE[data[at:stop]])
            stop_here = max(text_end, at + int(spaces[-1]) + 1 if len(spaces) else 0)
            if stop_here <= at:  # one word fills the window: go on to its end
                after = int(bounds[np.searchsorted(bounds, stop, side="left")])
                spaces = np.flatnonzero(_SPACE[data[stop:after]])
                stop_here = stop + int(spaces[0]) if len(spaces) else after
            stop = stop_here
        yield at, stop
        at = stop


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in order."""
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at, stop in _cuts(data, bounds):
        window = data[at:stop]
        n = len(window)
        up, down = (_UP, _DOWN) if n <= _WINDOW else (_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n))
        word = ~_SPACE[window]
        opens = np.ones(n + 1, dtype=bool)  # a text or a word begins here
        opens[1:n] = ~word[:-1]
        texts = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, stop)] - at
        opens[texts] = True
        first = np.flatnonzero(word & opens[:n])
        closes = opens[1:].copy()
        closes[: n - 1] |= ~word[1:]
        last = np.flatnonzero(word & closes)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[window] * up[:n], dtype=np.uint64)])
        value = (sums[last + 1] - sums[first]) * down[first]
        hashes.append(mixed(value + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        owners.append(np.searchsorted(bounds, first + at, side="right") - 1)
    return np.concatenate(hashes), np.concatenate(owners)


def _sets(data: np.ndarray, bounds: np.ndarray, n: int) -> list[np.ndarray]:
    words, owner = _words(data, bounds)
    factors = _powers(0xA0761D6478BD642F, n)
    texts = len(bounds) - 1
    counts = np.bincount(owner, minlength=texts)
    begins = np.cumsum(counts) - counts
    grams = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for i in range(n):
        grams += words[i : i + len(grams)] * factors[n - 1 - i]
    grams = mixed(grams)
    found = []
    for start, count in zip(begins.tolist(), counts.tolist()):
        if count >= n:
            found.append(np.unique(grams[start : start + count - n + 1]))
        elif count:
            whole = np.sum(words[start : start + count] * factors[n - count :][::-1], dtype=np.uint64)
            found.append(mixed(np.array([whole]), salt=count))
        else:
            found.append(grams[:0])
    return found


def gram_sets(batch: pa.RecordBatch, n: int, column: str = "text") -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """The distinct hashed n-grams of the texts of a batch, sorted, for rows from … to.

    Words are lower-cased (A to Z) and end at ASCII spaces. A text with fewer than n words
    has the whole sequence as its one element, and none if it has no words.
    """
    texts = batch.column(column).cast(pa.large_string())
    validity, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(ends, ends[row] + _SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        yield row, stop, _sets(data, ends[row : stop + 1], n)
        row = stop
