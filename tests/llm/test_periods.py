import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kerbside.llm import periods
from tests_llm_data import HARD, LONG, SF


def plain_runs(words):
    """Every maximal stretch of each period, longest stretches of equal bounds under their smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def plain(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_runs_of_random_sequences_against_all_periods():
    rng = random.Random(5)
    for _ in range(1500):
        words = [rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3) if words else 0):
            p, start = rng.randint(1, 1 + len(words) // 5), rng.randrange(len(words))
            for i in range(start + p, rng.randint(start, len(words))):
                words[i] = words[i - p]
        got = list(zip(*(column.tolist() for column in periods.runs_of(np.array(words, np.int64)))))
        assert sorted(got) == plain_runs(words)


@pytest.mark.parametrize("period", [1, 2, 3, 31, 32, 33, 250])
def test_long_runs_and_their_multiples(period):
    words = list(range(40)) + [100 + i for i in range(period)] * 8 + [7, 8, 9]
    got = [tuple(int(x) for x in run) for run in zip(*periods.runs_of(np.array(words, np.int64)))]
    assert (40, 8 * period, period) in got or period == 1 and got == [(40, 8, 1)]
    assert got == [run for run in plain_runs(words)]


def test_range_successor_against_search():
    rng = np.random.default_rng(3)
    values = rng.permutation(100)
    tree = periods.WaveletMatrix(values, 100)
    left = rng.integers(0, 100, 400)
    right = np.minimum(100, left + rng.integers(0, 60, 400))
    low = rng.integers(-5, 110, 400)
    high = low + rng.integers(-3, 40, 400)
    for i, found in enumerate(tree.successor(left, right, low, high)):
        fits = [v for v in values[left[i] : right[i]] if low[i] <= v <= high[i]]
        assert found == min(fits, default=-1)


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periods.runs_of(np.zeros(9, np.int64), least_periods=2)


def test_sequences_do_not_meet(spark, build):
    """Many texts in one sequence, and one text longer than a sequence."""
    rows = [(i, "a " * (i % 9) + "b", "en", "a") for i in range(60)] + [(70, "x y " * 40_000, "en", "a"), (71, LONG, "en", "b")]
    rows = {(r.doc_id, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in periods.find(build(rows)).collect()}
    assert (8, ((0, 8, 1),), "a b") in rows and (3, (), "a a a b") in rows
    assert (70, ((0, 80_000, 2),), "x y") in rows
    once = " ".join(LONG.split()[: 977 * 13])  # LONG repeats itself after that
    assert (71, ((0, 60_000, 977 * 13),), once) in rows


def test_query_against_plain_work(spark, build, tmp_path):
    rows = [(i, "one two three four five six seven eight nine ten " * 3, "en", "a") for i in range(60)]
    rows += [(100, "la " * 30 + "end", "en", "b"), (101, "x y x y\t" * 9, "en", "b")]
    rows += [row for row in HARD if row[1] is None or len(row[1]) < 5000]
    build(rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain(r[0], r[1]) for r in rows), key=repr)
    assert any(row.n_runs for row in got if (row.doc_id or 100) < 60)


def test_query_on_the_table(spark):
    """Texts of up to 2,000 words against all periods; every row is there."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in entry.queries()["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(documents)
    for row in documents:
        if len(row.text or "") < 6000:
            assert got[row.doc_id] == plain(row.doc_id, row.text)


def test_no_rows(spark, build):
    assert periods.find(build([])).count() == 0
    assert periods.find(build([(1, None, "en", "a")])).select(F.size("runs")).first()[0] == 0
