"""Runs: stretches of words that repeat with a period, found by internal pattern matching.

Texts are joined to sequences of bounded length, with a separator of its own after each,
and a sequence gets a suffix array by doubling; the classes of each doubling step give the
range of the array where the occurrences of a block of dyadic length lie. A run of period q
that is at least four periods long holds a block of length B, q < B <= 2q, at a multiple of
B whose next or former occurrence is q away. So each block asks for its occurrences in the
two windows from B/2 to B - 1 words away: the range successor in a wavelet matrix over the
suffix array. A lone occurrence gives its distance as candidate; several form a progression
whose difference is the period p of the block, and then q leads from an end of the
stretch of period p around the block to that end of the stretch around the progression. So
a block has a few candidates, each extended to both sides as far as it holds.

Every document is a row of its own and stays in its task; nothing is shuffled. Memory grows
with the longest text only: about 200 bytes a word.

Defined cases: a null or empty text, or one of spaces, has no words and no runs. Rows that
repeat an id are rows of their own. A null id is carried; ``planted`` leaves its text as it
is. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches

LEAST_LENGTH = 6
LEAST_PERIODS = 4
SEQUENCE_WORDS = 1 << 16
_FOUND = (
    "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
)
#: From a document's id and number of words to the numbers of the words that make its text, or None for all.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Texts of one id in ten repeat a part of themselves up to their end."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


class Factors:
    """A suffix array, and per k the class of the factor of length 2**k at each place.

    A class is named by the place in the array where its suffixes begin.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.n, self.order = n, np.argsort(symbols, kind="stable")
        values = symbols[self.order]
        opens = np.append(True, values[1:] != values[:-1])
        places = np.arange(n)
        named = np.maximum.accumulate(np.where(opens, places, 0))
        classes = np.empty(n, np.int32)
        classes[self.order] = named
        self.classes = [classes]
        length = 1
        while True:
            # Only suffixes that are not told apart yet are sorted again.
            alike = np.zeros(n, bool)
            alike[1:] = named[1:] == named[:-1]
            alike[:-1] |= alike[1:]
            again = np.flatnonzero(alike)
            if not len(again):
                break
            suffixes = self.order[again]
            after = suffixes + length
            following = np.where(after < n, classes[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
            keys = named[again] * np.int64(n + 1) + following
            by = np.argsort(keys)
            keys, suffixes = keys[by], suffixes[by]
            self.order[again] = suffixes
            opens = np.append(True, keys[1:] != keys[:-1])
            named[again] = np.maximum.accumulate(np.where(opens, again, 0))
            classes = classes.copy()
            classes[suffixes] = named[again]
            self.classes.append(classes)
            length *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols from i and from j on."""
        i, j, from_ = i.copy(), j.copy(), i
        for k in reversed(range(len(self.classes))):
            inside = np.flatnonzero((i < self.n) & (j < self.n))
            equal = inside[self.classes[k][i[inside]] == self.classes[k][j[inside]]]
            i[equal] += 1 << k
            j[equal] += 1 << k
        return i - from_

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal symbols before i and before j."""
        i, j, from_ = i.copy(), j.copy(), i
        for k in reversed(range(len(self.classes))):
            inside = np.flatnonzero((i >= 1 << k) & (j >= 1 << k))
            equal = inside[self.classes[k][i[inside] - (1 << k)] == self.classes[k][j[inside] - (1 << k)]]
            i[equal] -= 1 << k
            j[equal] -= 1 << k
        return from_ - i


class WaveletMatrix:
    """Values below a bound, for counts and order statistics of any range of places."""

    def __init__(self, values: np.ndarray, bound: int):
        self.bits = max(1, int(bound - 1).bit_length())
        self.zeros = []
        for bit in reversed(range(self.bits)):
            high = ((values >> bit) & 1).astype(bool)
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~high, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~high], values[high]])

    def _step(self, zeros, left, right, ones):
        left0, right0 = zeros[left], zeros[right]
        left = np.where(ones, zeros[-1] + left - left0, left0)
        return left, np.where(ones, zeros[-1] + right - right0, right0)

    def below(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of places left to right are less than x, itself below the bound."""
        count = np.zeros(len(left), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            ones = ((x >> bit) & 1).astype(bool)
            count += np.where(ones, zeros[right] - zeros[left], 0)
            left, right = self._step(zeros, left, right, ones)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k, from 0, among places left to right."""
        value, k = np.zeros(len(left), np.int64), k.copy()
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            low = zeros[right] - zeros[left]
            ones = k >= low
            k -= np.where(ones, low, 0)
            value |= ones.astype(np.int64) << bit
            left, right = self._step(zeros, left, right, ones)
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value from ``low`` to ``high`` among places left to right; -1 if there is none."""
        found = np.full(len(left), -1, np.int64)
        ask = np.flatnonzero((low <= high) & (low < 1 << self.bits))
        rank = self.below(left[ask], right[ask], np.maximum(low[ask], 0))
        there = rank < right[ask] - left[ask]
        ask, rank = ask[there], rank[there]
        value = self.nth(left[ask], right[ask], rank)
        found[ask] = np.where(value <= high[ask], value, -1)
        return found


def _blocks(factors: Factors) -> tuple[np.ndarray, ...]:
    """Start, length, and range in the suffix array of all aligned dyadic blocks that occur more than once."""
    starts, lengths, lefts, rights = [], [], [], []
    for k, classes in enumerate(factors.classes[1:], start=1):
        at = np.arange(0, factors.n - (1 << k) + 1, 1 << k)
        sizes = np.bincount(classes, minlength=factors.n)
        left = classes[at].astype(np.int64)
        several = sizes[left] > 1
        at, left = at[several], left[several]
        starts.append(at)
        lengths.append(np.full(len(at), 1 << k))
        lefts.append(left)
        rights.append(left + sizes[left])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]).astype(np.int64) for x in (starts, lengths, lefts, rights))


def _candidates(factors: Factors) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, period): every run with four periods holds a place paired with its period."""
    at, length, left, right = _blocks(factors)
    occurrences = WaveletMatrix(factors.order, factors.n)
    places, periods = [], []
    for side in (1, -1):
        near, far = at + side * (length // 2), at + side * (length - 1)
        low, high = np.minimum(near, far), np.maximum(near, far)
        first = occurrences.successor(left, right, low, high)
        some = np.flatnonzero(first >= 0)
        a, b, x = at[some], length[some], first[some]
        second = occurrences.successor(left[some], right[some], x + 1, high[some])
        lone = second < 0
        found = [(a[lone], side * (x[lone] - a[lone]), b[lone])]
        a, b, x, p = a[~lone], b[~lone], x[~lone], second[~lone] - x[~lone]
        ends = (x + factors.ahead(x, x + p)) - (a + factors.ahead(a, a + p))
        begins = (x - factors.behind(x, x + p)) - (a - factors.behind(a, a + p))
        found += [(a, side * ends, b), (a, side * begins, b)]
        for place, q, block in found:
            fits = (q >= block // 2) & (q < block)
            places.append(place[fits])
            periods.append(q[fits])
    pairs = np.unique(np.stack([np.concatenate(places), np.concatenate(periods)]), axis=1)
    return pairs[0], pairs[1]


def runs_of(
    symbols: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of a sequence, by start and period.

    ``least_periods`` is 4 or more: the blocks are laid for that.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than four periods are not found")
    if len(symbols) < least_length:
        return (np.zeros(0, np.int64),) * 3
    # An end that occurs nowhere else tells all suffixes apart.
    factors = Factors(np.append(symbols, symbols.max() + 1))
    at, q = _candidates(factors)
    start = at - factors.behind(at, at + q)
    end = at + q + factors.ahead(at, at + q)
    runs = end - start >= np.maximum(least_length, least_periods * q)
    start, end, q = start[runs], end[runs], q[runs]
    # A multiple of a run's period gives the same stretch.
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], (end - start)[order], q[order]


def _dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Places of a sequence that lie in a run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth[:-1]) > 0


def _sequence(rows: list[tuple], least_length: int, least_periods: int) -> pa.RecordBatch:
    """Found rows of documents (id, words, numbers of the words), searched as one sequence."""
    known: dict[bytes, int] = {}
    parts, ends = [], [0]
    for _, words, numbers in rows:
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        parts += [ids if numbers is None else ids[numbers], np.zeros(1, np.int64)]
        ends.append(ends[-1] + len(words) + 1)
    symbols = np.concatenate(parts)
    bounds = np.array(ends)
    symbols[bounds[1:] - 1] = len(known) + np.arange(len(rows))
    start, length, period = runs_of(symbols, least_length, least_periods)
    gone = _dropped(len(symbols), start, length, period)
    cuts = np.searchsorted(start, bounds)
    runs, texts = [], []
    for row, (_, words, numbers) in enumerate(rows):
        own = slice(cuts[row], cuts[row + 1])
        columns = (start[own] - bounds[row], length[own], period[own])
        runs.append([dict(zip(("start", "length", "period"), run)) for run in zip(*(c.tolist() for c in columns))])
        if runs[-1] or numbers is not None:
            keep = np.flatnonzero(~gone[bounds[row] : bounds[row + 1] - 1])
            words = [words[i] for i in (keep if numbers is None else numbers[keep]).tolist()]
        texts.append(b" ".join(words))
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    columns = [
        pa.array([row[0] for row in rows], pa.int64()),
        pa.array([len(row[1]) for row in rows], pa.int64()),
        pa.array(runs, kind),
        pa.array(texts, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def find(
    documents: DataFrame,
    rewrite: Rewrite | None = None,
    least_length: int = LEAST_LENGTH,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start) and the text without repetitions.

    Words are what spaces part, and are numbered from 0. In the collapsed text, words joined
    by one space, a run is cut to its first period. ``rewrite`` changes texts before the search.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = [], 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                words = (text.as_py() or b"").split()
                rows.append((doc_id, words, rewrite(doc_id, len(words)) if rewrite else None))
                total += len(words) + 1
                if total >= SEQUENCE_WORDS:
                    yield _sequence(rows, least_length, least_periods)
                    rows, total = [], 0
        if rows:
            yield _sequence(rows, least_length, least_periods)

    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, _FOUND)


def longest(runs: Column) -> Column:
    """The longest of an array of runs, then that of smallest start and period; null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(ranked)
    return F.when(F.size(runs) > 0, F.struct(best["s"].alias("start"), (-best["l"]).alias("length"), best["p"].alias("period")))


def listed(runs: Column) -> Column:
    """Runs as lines of start, length and period."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(lines, "")
