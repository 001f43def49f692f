"""Top-k search against brute force."""

import random

import pytest

from kerbside.llm import topk

NAN, INF = float("nan"), float("inf")


def brute(rows, k, every):
    import math

    ok = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in ok:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = set()
    for q, a in queries.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)}
    return out


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string, rank string").repartition(3)

    return make


def rows(seed, n, width, spread=1.0):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0, spread) * 8) / 8 * (1 if r.random() < 0.7 else 0.1) for _ in range(width)]) for i in range(n)]


def f32(data):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]


@pytest.mark.parametrize("seed, n, width", [(1, 700, 12), (2, 60, 3), (3, 9, 5)])
def test_random_vectors(vectors, monkeypatch, seed, n, width):
    """Small shards, blocks and strides, so that thresholds, ties and merges all occur."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 64)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 5)
    monkeypatch.setattr(topk, "STRIDE", 16)
    data = f32(rows(seed, n, width))
    found = topk.nearest(vectors([(i, v, "clash", "clash") for i, v in data]), every=7)
    assert {tuple(r) for r in found.collect()} == brute(data, 10, 7)


def test_hard_rows(vectors):
    data = rows(5, 40, 4) + [
        (None, [1.0] * 4), (100, None), (200, []), (300, [1.0, None]), (400, [NAN, 1.0]), (500, [INF, 1.0]),
        (41, [0.0] * 4), (42, [-3.0] * 4), (42, [-3.0] * 4), (30, [2.0]), (0, [9.0, 9.0, 9.0, 9.0, 9.0]),
    ]
    data = f32(data)
    found = topk.nearest(vectors([(i, v, None, None) for i, v in data]), every=10)
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute_rows(data))


def brute_rows(data):
    return brute(data, 10, 10)


def test_no_rows(vectors):
    assert topk.nearest(vectors([])).count() == 0
    assert topk.nearest(vectors([(0, [1.0], None, None)])).count() == 0


def test_non_essential_terms_are_probed_only_for_some():
    """Scoring stops early for candidates that cannot compete, with the same result."""
    import numpy as np

    r = np.random.default_rng(4)
    cells = (r.normal(size=(3000, 32)) * np.geomspace(500, 1, 32)).astype(np.int64)
    shard = topk.Shard(np.arange(3000), cells)
    query = cells[7]
    want = sorted(((int(s), i) for i, s in enumerate(cells @ query) if i != 7), key=lambda x: (-x[0], x[1]))[:10]
    assert shard.best(7, query, 10) == want
