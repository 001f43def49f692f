import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import lexical
from tests_llm_data import HARD

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(documents, items, k):
    """Scores of all pairs in plain integers."""
    counted = [(doc_id, Counter(split(text))) for doc_id, text in documents]
    counted = [(doc_id, c) for doc_id, c in counted if c]
    n, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    asked = {}
    for item, text in items:
        asked[item] = asked.get(item, []) + split(text)
    rows = []
    for item, terms in asked.items():
        scores = []
        for doc_id, c in counted:
            m = 75 + (25 * c.total() * n) // words
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, without, doc_id) in enumerate(sorted(scores)[:k], 1):
            rows.append((item, rank, None if without else doc_id, -score))
    return sorted(rows, key=repr)


@pytest.fixture
def frames(spark):
    def make(documents, items, parts=4):
        left = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(parts)
        right = spark.createDataFrame(items, "item_id bigint, text string")
        for name in ("rank", "score", "term", "repeats", "df", "ids", "terms"):
            left, right = left.selectExpr("*", f"'clash' AS {name}"), right.selectExpr("*", f"'clash' AS {name}")
        return left, right

    return make


def rows_of(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def zipf_texts(seed, n, longest):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("vocabulary", [lexical.VOCABULARY, 3])
def test_search_against_all_scores(spark, frames, monkeypatch, vocabulary):
    """Many small shards and blocks; several passes; an index of the asked terms or of all."""
    for name, value in (("SHARD_DOCUMENTS", 32), ("BLOCK_POSTINGS", 4), ("QUERY_ROWS", 60)):
        monkeypatch.setattr(lexical, name, value)
    documents = list(enumerate(zipf_texts(1, 400, 60))) + [(i + 400, t) for i, t in enumerate(zipf_texts(1, 40, 60))]
    items = list(enumerate(zipf_texts(2, 15, 25))) + [(3, "w1 w1 w250"), (20, "unknown"), (21, None), (22, "")]
    got = rows_of(lexical.search(*frames(documents, items), k=7, vocabulary=vocabulary))
    assert got == plain(documents, items, 7)


def test_hard_rows(spark, frames):
    documents = [(row[0], row[1]) for row in HARD] + [(90, "one THREE"), (None, "one three"), (91, "one three"), (91, "one three")]
    items = [(1, "One two, three!"), (2, "the same words w5x3 w9x9"), (None, "é ärger"), (4, None)]
    assert rows_of(lexical.search(*frames(documents, items))) == plain(documents, items, lexical.K)


def test_no_rows(spark, frames):
    some = [(1, "a b")]
    assert lexical.search(*frames([], some, 1)).count() == 0
    assert lexical.search(*frames(some, [])).count() == 0
    assert lexical.search(*frames([(1, None), (2, " .. ")], some)).count() == 0


def test_blocks_are_rejected_before_they_are_unpacked(monkeypatch):
    """One document holds the rare term; of the common term's blocks only its own is read."""
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", 8)
    builder = lexical._Builder(None)
    for i in range(200):
        builder.add(i, b"common filler%d" % i + (b" rare" if i == 77 else b""))
    shard = lexical.Shard(builder.batch().to_pylist()[0], 200, 401)
    read = []
    unpack = shard._unpack
    shard._unpack = lambda blocks: (read.append(len(blocks)), unpack(blocks))[1]
    query = [(b"common", lexical.weight(200, 200)), (b"rare", lexical.weight(200, 1))]
    places, scores = shard.best(query, int(query[1][1] * shard.list_most[shard.numbers[b"rare"]]))
    assert places.tolist() == [77] and read == [1, 1]
    assert shard.best(query, int(scores[0]) * 2)[0].tolist() == []


def test_bounds_are_the_largest_scores_of_their_blocks():
    rng = random.Random(4)
    builder = lexical._Builder(None)
    for i in range(500):
        builder.add(i, b" ".join(rng.choices([b"a", b"b", b"c"], k=rng.randint(1, 40))))
    shard = lexical.Shard(builder.batch().to_pylist()[0], 500, 10_000)
    for term in shard.numbers.values():
        blocks = range(shard.blocks[term], shard.blocks[term + 1])
        most = [int(shard._unpack(np.array([b]))[1].max()) for b in blocks]
        assert most == shard.most[blocks.start : blocks.stop].tolist()
        assert shard.list_most[term] == max(most)


def test_codes():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2**40, 2**61], np.int64)
    assert lexical.unpacked(lexical.packed(values)[0]).tolist() == values.tolist()
    assert len(lexical.unpacked(lexical.packed(values[:0])[0])) == 0
