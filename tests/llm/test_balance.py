"""Shards, mixes and packed sequences: nothing lost, sizes and targets as promised."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.llm import mixing, packing, sharding
from tests_llm_data import HARD, LONG


@pytest.mark.parametrize("clash", [False, True])
def test_shards_hold_every_row_once(build, clash):
    rows = HARD + [(100 + i, f"text {i} " * (i % 50), "en", "s") for i in range(500)]
    found = sharding.shard(build(rows, clash), 4).select("doc_id", "text", "size", "shard", "slot").collect()
    assert Counter((r[0], r[1]) for r in found) == Counter((r[0], r[1]) for r in rows)
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 for r in found)
    for shard in range(4):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))


def test_shards_are_even_and_keep_copies_together(build):
    rows = [(i, f"text {i // 3} " * 40, "en", "s") for i in range(6000)]
    found = sharding.shard(build(rows), 8)
    sizes = [r[1] for r in found.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.05 * min(sizes)
    assert found.groupBy("text").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0


def test_a_text_of_most_documents_is_divided(build):
    rows = [(i, "the same " * 30 if i % 4 else f"text {i} " * 30, "en", "s") for i in range(4000)]
    sizes = [r[1] for r in sharding.shard(build(rows), 8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.05 * min(sizes)


def test_shards_in_several_parts(build):
    rows = [(i, f"text {i} " * 40, "en", "s") for i in range(3000)]
    found = sharding.shard(build(rows), 3, part_bytes=50_000).select("shard", "slot").collect()
    assert max(n for n in Counter(r["shard"] for r in found).values()) < 1100
    for shard in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_no_rows(build):
    assert sharding.shard(build([])).count() == 0
    assert mixing.mix(build([])).count() == 0
    assert packing.pack(build([])).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_mix_of_hard_rows(build, clash):
    found = mixing.mix(build(HARD, clash)).collect()
    assert len(found) == len(HARD)
    sizes = Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
    for r in found:
        assert r["size"] == len((r["text"] or "").replace(" ", "x").split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] <= 2 * r["source_size"] and r["taken_times"] <= 2
    copies = mixing.emit(mixing.mix(build(HARD, clash)))
    assert copies.count() == sum(r["taken_times"] for r in found)


def water_level(sizes, weights, share, most):
    """Targets by capping one source at a time."""
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        worst = [i for i in open_ if weights[i] * level > most * sizes[i]]
        if not worst:
            for i in open_:
                target[i] = weights[i] * level
            break
        for i in worst:
            target[i] = most * sizes[i]
            left -= target[i]
            open_.remove(i)
    return target


def test_targets_and_draws(build):
    names = ["b", "a", "Z", None, "é", "c", "d"]
    rows = [(i, "word " * (1 + i * 7 % 30), "en", names[i * i % 7]) for i in range(7000)]
    mixed = mixing.mix(build(rows))
    found = mixed.groupBy("source").agg(
        F.first("source_size"), F.first("target"), F.sum(F.col("size") * F.col("taken_times"))
    ).collect()
    ordered = sorted(found, key=lambda r: (r[0] is None, r[0] or ""))
    want = water_level([r[1] for r in ordered], [3, 1, 2] * 3, 1.5, 2.0)
    for row, target in zip(ordered, want):
        assert row[2] == pytest.approx(target) and row[3] == pytest.approx(target, rel=0.06)
    again = mixing.mix(build(reversed(rows))).select("doc_id", "taken_times").collect()
    assert {tuple(r) for r in again} == {(r["doc_id"], r["taken_times"]) for r in mixed.collect()}


def test_best_fit_prefers_the_tightest_bin():
    bins, starts, capacity, used = packing.pack_lengths([60, 50, 40, 30], lengths=(100,))
    assert used[bins[2]] == 100 and bins[2] == bins[0] and starts[2] == 60
    assert bins[3] == bins[1] and capacity == [100, 100] and sum(used) == 180
    # What stays in a bin decides its final length.
    assert packing.pack_lengths([10], lengths=(64, 16, 32), cost=lambda c: c)[2] == [16]
    assert packing.pack_lengths([])[0] == []


@pytest.mark.parametrize("clash", [False, True])
def test_packing_holds_every_word_once(build, clash):
    found = packing.pack(build(HARD, clash)).collect()
    words = Counter()
    for r in found:
        words[r["doc_id"]] += r["words"]
        assert r["start"] + r["words"] <= r["used"] <= r["capacity"] and r["capacity"] in packing.LENGTHS
    want = Counter()
    for doc_id, text, *_ in HARD:
        want[doc_id] += len((text or "").replace(" ", "x").split())
    assert words == want
    assert [r["piece"] for r in found if r["doc_id"] == 4 and r["words"]].count(0) == 1
    assert sum(r["words"] == 8192 for r in found if r["doc_id"] == 4) == len(LONG.split()) // 8192
    by_bin = {}
    for r in found:
        by_bin.setdefault(r["bin_id"], []).append(r)
    for pieces in by_bin.values():
        pieces.sort(key=lambda r: (r["start"], r["words"]))
        assert sum(r["words"] for r in pieces) == pieces[0]["used"]
        assert all(a["start"] + a["words"] <= b["start"] for a, b in zip(pieces, pieces[1:]))


def test_lengths_are_chosen_jointly():
    """Long pieces open long bins, short ones the length that costs least a word."""
    sizes = sorted([8000] * 5 + [300] * 400, reverse=True)
    bins, _, capacity, used = packing.pack_lengths(sizes)
    assert capacity.count(2048) > 10 and all(capacity[b] == 8192 for b in bins[:5])
    assert sum(used) / sum(capacity) > 0.9
