"""Near duplicates against brute force, and the parts of the join."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import common, jaccard, shingles
from kerbside.llm.prefix_tree import PrefixTree, links, needed
from kerbside.llm.shingles import gram_sets
from tests_llm_data import HARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def gram_set(text, n=5):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def expected(rows):
    sets = defaultdict(list)
    for doc_id, text, *_ in rows:
        sets[doc_id].append(gram_set(text))
    root = {doc_id: doc_id for doc_id in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return Counter((d, len(gram_set(t)), find(d) if d is not None else None) for d, t, *_ in rows)


def got(documents, **kw):
    columns = ["doc_id", "n_shingles", "component_id"]
    return Counter(tuple(r) for r in jaccard.join(documents, **kw).select(columns).collect())


def variants(seed, n, groups):
    """Texts with more and less changed copies of them, and a passage in all."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(30)]
    rows = []
    for g in range(groups):
        base = [r.choice(words) for _ in range(r.randint(3, 120))]
        for _ in range(n):
            text = [w if r.random() > 0.02 else r.choice(words) for w in base]
            at = r.randint(0, len(text))
            rows.append((len(rows), " ".join(text[:at] + passage + text[at:] if r.random() < 0.4 else text), None, None))
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_hard_rows(build, clash):
    assert got(build(HARD, clash)) == expected(HARD)


def test_no_rows(build):
    assert not got(build([]))
    assert got(build([(1, None, None, None), (2, " ", None, None)])) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})


def test_random_copies(build):
    rows = variants(3, 8, 25)
    assert got(build(rows)) == expected(rows)


def test_groups_of_many_blocks(build, monkeypatch):
    """Groups far above the size of a block, and elements dealt to several tasks."""
    monkeypatch.setattr(jaccard, "GROUP", 7)
    monkeypatch.setattr(jaccard, "_SALTED", 4)
    monkeypatch.setattr(jaccard, "_PAIRED", 5)
    rows = variants(5, 60, 4)
    assert got(build(rows)) == expected(rows)


def test_exactly_at_the_threshold(build):
    """12 of 16 different 5-grams are shared: similar; 11 of 17 are not."""
    words = [f"a{i}" for i in range(18)]
    close = words[:16] + ["x", "y"]
    far = words[:15] + ["p", "q", "r"]
    rows = [(1, " ".join(words), None, None), (2, " ".join(close), None, None), (3, " ".join(far), None, None)]
    assert 100 * len(gram_set(rows[0][1]) & gram_set(rows[1][1])) == 75 * len(gram_set(rows[0][1]) | gram_set(rows[1][1]))
    assert got(build(rows)) == expected(rows)
    assert sum(n for (_, _, c), n in expected(rows).items() if c == 1) == 2


def test_gram_sets_do_not_depend_on_batches(monkeypatch):
    from kerbside.llm import shingles

    texts = [t or "" for _, t, *_ in HARD] + [r[1] for r in variants(1, 2, 20)] + ["z" * 5000, "q " * 4000]

    def sets():
        batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
        return [s.tolist() for _, _, found in gram_sets(batch, 5) for s in found]

    whole = sets()
    assert [len(s) for s in whole] == [len(gram_set(t)) for t in texts]
    monkeypatch.setattr(shingles, "_WINDOW", 1 << 9)
    monkeypatch.setattr(shingles, "_SLICE_BYTES", 1 << 10)
    assert sets() == whole


def test_tree_finds_what_plain_comparison_finds():
    r = random.Random(2)
    base = [np.unique(np.array([r.randrange(300) for _ in range(r.randint(1, 60))], dtype=np.uint64)) for _ in range(12)]
    sets = {}
    for _ in range(150):
        own = set(r.choice(base).tolist())
        own = {x for x in own if r.random() > 0.08} | {r.randrange(300) for _ in range(r.randrange(3))}
        if own:
            sets[tuple(sorted(own))] = np.array(sorted(own), dtype=np.uint64)
    sets = list(sets.values())
    tree = PrefixTree(sets)
    low, high = np.append(np.arange(len(sets)), 1 << 60), np.append(np.arange(len(sets)), -1)
    plain = [set(s.tolist()) for s in sets]
    similar = lambda i, j: len(plain[i] & plain[j]) >= needed(len(plain[i]), len(plain[j]), 75)
    for place, number in enumerate(tree.order):
        found = {int(tree.order[k]) for k in tree.search(number, 75, low, high, place)} - {int(number)}
        assert found == {j for j in range(len(sets)) if j != number and similar(number, j)}
    for groups in (list(range(len(sets))), [i % 5 for i in range(len(sets))], [min(i, 60) for i in range(len(sets))]):
        assert joined(groups, links(sets, groups, 75)) == joined(
            groups, [(i, j) for i in range(len(sets)) for j in range(i) if similar(i, j)]
        )


def joined(groups, pairs):
    root = list(range(len(groups)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    firsts = {}
    for i, g in enumerate(groups):
        root[find(i)] = find(firsts.setdefault(g, i))
    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    names = {}
    return [names.setdefault(find(i), i) for i in range(len(groups))]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 101), (300, 300)]
    found = {r[0]: r[1] for r in jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
    assert jaccard.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_texts_of_one_id_are_one_document(build):
    """Ids with two texts tie their components together; a text without words goes along."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, one, None, None), (5, one + " end", None, None), (5, two, None, None), (7, two + " end", None, None)]
    rows += [(7, None, None, None), (4, three, None, None), (8, three + " end", None, None), (8, three, None, None)]
    assert got(build(rows)) == expected(rows)
    kept = {(r["doc_id"], r["n_shingles"]) for r in jaccard.join(build(rows)).filter("kept").collect()}
    assert kept == {(3, 36), (5, 36), (7, 0), (4, 36)}


def test_memory_of_sets_does_not_grow_with_the_batch():
    """Sets of a batch of 6 MB take a few MB on their way; a worker keeps what its tasks once took."""
    text = " ".join(f"w{i * 7919 % 65537}" for i in range(2_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * (6_000_000 // len(text)))], ["text"])
    for _ in shingles.gram_sets(batch.slice(0, 1), 5):
        pass
    tracemalloc.start()
    try:
        for _ in shingles.gram_sets(batch, 5):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20


def test_tidy_hands_on_every_batch_and_frees_at_the_end(monkeypatch):
    freed = []
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: SimpleNamespace(malloc_trim=freed.append))
    batches = [pa.RecordBatch.from_arrays([pa.array([i])], ["n"]) for i in range(3)]
    rows = common.tidy(lambda some: iter(some))(iter(batches))
    assert next(rows) is batches[0] and not freed
    assert list(rows) == batches[1:] and freed == [0]
    left = common.tidy(lambda some: iter(some))(iter(batches))
    next(left)
    left.close()  # a task that needs no more rows
    assert freed == [0, 0]
