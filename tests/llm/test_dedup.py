"""Exact and line deduplication against plain Python."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import pytest

from kerbside.llm import exact_dedup, line_dedup
from kerbside.workspace import scratch

from tests_llm_data import HARD

SPACE = re.compile(r"[\x20\x09-\x0D]")


def written(spark, frame):
    path = scratch(spark, "test-dedup")
    frame.write.parquet(path)
    return path


def expected_copies(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        text = text or ""
        groups[SPACE.sub("", text)].append((-len(text), doc_id is None, doc_id))
    out = []
    for bare, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(bare.encode()).hexdigest()
        out += [(m[2], members[0][2], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_copies(spark, build, clash):
    found = exact_dedup.dedupe(spark, written(spark, build(HARD, clash)))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == expected_copies(HARD)


def test_no_rows(spark, build):
    assert exact_dedup.dedupe(spark, written(spark, build([]))).count() == 0
    assert line_dedup.keep_bitmaps(build([])).count() == 0


def test_state_goes_on(spark, build):
    """Files that come later meet what the state has seen; one file a batch."""
    path, checkpoint = written(spark, build(HARD[:6])), scratch(spark, "test-state")
    exact_dedup.dedupe(spark, path, checkpoint=checkpoint, files_per_batch=1)
    build(HARD[6:]).write.mode("append").parquet(path)
    found = exact_dedup.dedupe(spark, path, checkpoint=checkpoint, files_per_batch=1)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == expected_copies(HARD)


def test_state_takes_late_files_of_any_age(spark, build):
    """Files that come later but are older by their times, as after a copy that preserves them."""
    path, checkpoint = written(spark, build(HARD[:6])), scratch(spark, "test-state")
    exact_dedup.dedupe(spark, path, checkpoint=checkpoint)
    before = set(os.listdir(path))
    build(HARD[6:]).write.mode("append").parquet(path)
    for days, name in enumerate(sorted(set(os.listdir(path)) - before)):
        os.utime(os.path.join(path, name), (86_400 * 365 * days,) * 2)
    found = exact_dedup.dedupe(spark, path, checkpoint=checkpoint)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == expected_copies(HARD)


def test_equal_digests_of_different_texts(spark, build, monkeypatch):
    """Bytes are compared on hits: with a digest of one letter, groups still go by the text."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(
        exact_dedup, "_digest", lambda: F.substring(F.sha2(exact_dedup.normalised(exact_dedup.text_of()), 256), 1, 1)
    )
    rows = [(i, f"text {i % 40}", None, None) for i in range(100)]
    found = exact_dedup.dedupe(spark, written(spark, build(rows))).select("doc_id", "keep_id", "group_size", "kept")
    sizes = Counter(i % 40 for i in range(100))
    got = {tuple(r) for r in found.collect()}
    assert got == {(i, i % 40, sizes[i % 40], i < 40) for i in range(100)}


def expected_lines(rows):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    lines = [(doc_id, (text or "").split("\n")) for doc_id, text in rows]
    holders = defaultdict(list)
    for i, (_, own) in enumerate(lines):
        for k in {key(line) for line in own}:
            if len(k) >= 20:
                holders[k].append(i)
    out = []
    for doc_id, own in lines:
        kept = []
        for line in own:
            held = holders.get(key(line), [])
            last = max((lines[i][0] for i in held if lines[i][0] is not None), default=None)
            if len(held) < 3 or doc_id == last:
                kept.append(line)
        out.append((doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_lines(build, clash):
    shared = "A line of more than TWENTY characters"
    other = "ÀÉ another line that many documents share"
    rows = [
        *((r[0], r[1]) for r in HARD),
        (20, f"{shared}\nown words\n{shared} \n\n{other}\n"),
        (21, f"{shared.lower()}\n{other}"),
        (22, f"\t{shared}\nlast of all\n{other}"),
        (22, f"\t{shared}\nlast of all\n{other}"),
        (23, "short\nshort\nshort"),
        (None, shared),
        (19, f"{shared.upper()}\n" * 3000 + "end"),
    ]
    documents = build([(i, t, None, None) for i, t in rows], clash)
    bitmaps = line_dedup.stored_bitmaps(documents)
    found = line_dedup.apply_bitmaps(documents, bitmaps)
    got = sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)
    assert got == expected_lines(rows)
    lost = {r["doc_id"]: r["keep_runs"] for r in bitmaps.collect()}
    assert [tuple(run) for run in lost[20]] == [(1, 1), (3, 1), (5, 1)]
    assert [tuple(run) for run in lost[19]] == [(3000, 1)] and 22 not in lost
