"""Archives, their merged index, and dated URL lists."""

import datetime as dt
import gzip
import hashlib
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from kerbside.llm import url_lists, warc
from kerbside.workspace import scratch

BIG = "<html>" + "the same page " * 20 + "</html>"
PAGES = [
    (1, "http://www.Example.org/a?b=1", BIG),
    (2, "http://www.example.org/a?b=1", BIG),
    (3, "https://b.example.org", "short"),
    (4, "https://b.example.org/\r\nX: y", "short"),
    (5, None, None),
    (6, "not a url", ""),
    (7, "http://é.example.org/ü", "payload with \r\n\r\nWARC/1.1\r\n breaks \r\n\r\n" + "é" * 200),
    (8, "http://a.org/", "x" * 3_000_000),
    (9, "http://a.org/", "x" * 3_000_000),
    (9, "http://a.org/", "x" * 3_000_000),
    (None, "http://a.org/", BIG),
    (None, "http://a.org/z", "without an id " * 20),
]


def pages(spark, rows):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    return frame.withColumns({c: F.lit("clash") for c in ("digest", "size", "first", "n", "range", "archive", "record")})


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page_id is not None:
            first[body] = min(page_id, first.get(body, page_id))
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        refers = first.get(body) if first.get(body) != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), kind, refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    found = warc.archive_history(pages(spark, PAGES))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == expected(PAGES)
    keys = {r["page_id"]: r["url_key"] for r in found.collect() if r["page_id"] is not None}
    assert keys[1] == keys[2] == "org,example,www)/a?b=1" and keys[5] == "" and keys[6] == "not a url"
    assert keys[4] == "org,example,b)/%0D%0AX: y"


def test_no_pages(spark):
    assert warc.archive_history(pages(spark, [])).count() == 0


def test_history_is_in_global_order(spark, monkeypatch):
    """Blocks of few captures and a URL that holds half of them."""
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 5)
    rows = [(i, "http://hot.org/" if i % 2 else f"http://h{i % 37}.org/{i % 11}", f"page {i}") for i in range(600)]
    random.Random(1).shuffle(rows)
    path = scratch(spark, "test-warc")
    warc.write_archives(pages(spark, rows), path)
    found = warc.capture_history(spark, path, ranges=8).collect()
    placed = sorted(found, key=lambda r: (r["range"], r["place"]))
    keys = [(r["url_key"], r["captured_at"], r["page_id"]) for r in placed]
    assert keys == sorted(keys) and len(keys) == 600
    assert len({r["range"] for r in found if r["url_key"] == "org,hot)/"}) > 1
    assert len({(r["archive"], r["position"]) for r in found}) == 600


def test_loser_tree_merges_like_sorted():
    r = random.Random(7)
    for runs in (1, 2, 3, 7, 20):
        blocks = []
        for _ in range(runs):
            run = sorted(r.randrange(50) for _ in range(r.randrange(1, 60)))
            entries = [{"url_key": f"{x:03d}", "captured_at": "", "page_id": None if x % 9 == 0 else x} for x in run]
            blocks += [entries[i : i + 7] for i in range(0, len(entries), 7)]
        blocks.sort(key=lambda b: warc._sort_key(b[0]))
        merged = [warc._sort_key(c) for c in warc.merge_blocks(iter(blocks))]
        assert merged == sorted(warc._sort_key(c) for b in blocks for c in b)


def test_damage_is_noticed():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [(b, at) for _, b, at, _ in warc.parse(good * 2)] == [(b"abc", 0), (b"abc", len(good))]
    for bad in (good[:-1] + b"x", b"x" + good, good.replace(b"3", b"2")):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_archives_of_many_gzip_members(spark, tmp_path):
    """A member for each record, as is usual, and an archive that breaks off."""
    path = scratch(spark, "test-warc")
    warc.write_archives(pages(spark, PAGES), path)
    whole = [gzip.decompress(p.read_bytes()) for p in pathlib.Path(path).glob("*.gz")]
    parts = [[archive[at : at + n] for _, _, at, n in warc.parse(archive)] for archive in whole]
    for i, members in enumerate(parts):
        (tmp_path / f"{i}.warc.gz").write_bytes(b"".join(map(gzip.compress, members)))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = warc.read_archives(spark, str(tmp_path)).select(columns).collect()
    assert sorted(map(tuple, found), key=repr) == expected(PAGES)
    packed = gzip.compress(b"one") + gzip.compress(b"two") + bytes(9)
    assert warc.unpack(memoryview(packed)) == b"onetwo"
    with pytest.raises(ValueError):
        warc.unpack(memoryview(packed[:-12]))


D = dt.date
ENTRIES = [
    ("block", "bad.org", "add", D(2024, 1, 10)),
    ("block", "bad.org", "remove", D(2024, 2, 1)),
    ("block", "bad.org", "add", D(2024, 3, 1)),
    ("block", "BAD.org", "add", D(2024, 3, 5)),
    ("allow", "good.bad.org", "add", D(2024, 1, 1)),
    ("block", "mixed.org/dir", "add", D(2024, 1, 1)),
    ("block", "same.org", "remove", D(2024, 1, 5)),
    ("block", "same.org", "add", D(2024, 1, 5)),
    (None, "bad.org", "add", D(2020, 1, 1)),
    ("block", None, "add", D(2020, 1, 1)),
    ("block", "x.org", "add", None),
    ("block", "late.org", None, D(2024, 6, 1)),
]
CAPTURES = [
    ("http://bad.org/", (2024, 1, 9), False, ""),
    ("http://bad.org/", (2024, 1, 10), True, "block:bad.org"),
    ("http://www.bad.org:80/x", (2024, 1, 31), True, "block:bad.org"),
    ("http://www.bad.org/x", (2024, 2, 1), False, ""),
    ("http://bad.org/", (2024, 3, 20), True, "block:bad.org"),
    ("http://bad.org/", (2024, 3, 20), True, "block:bad.org"),
    ("https://a.good.bad.org/", (2024, 1, 15), False, "allow:good.bad.org block:bad.org"),
    ("http://notbad.org/", (2024, 1, 15), False, ""),
    ("http://u@mixed.org/dir/x", (2024, 1, 15), True, "block:mixed.org/dir"),
    ("http://mixed.org/other", (2024, 1, 15), False, ""),
    ("http://same.org", (2024, 1, 5), True, "block:same.org"),
    ("http://late.org", (2024, 7, 5), True, "block:late.org"),
    ("nonsense", (2024, 1, 5), False, ""),
    (None, (2024, 1, 5), False, ""),
    ("http://bad.org/", None, False, ""),
    ("http://" + "a." * 3000 + "bad.org/", (2024, 1, 15), True, "block:bad.org"),
]


def test_lists_as_of_the_fetch(spark):
    rows = [(u, dt.datetime(*t, 12) if t else None, "clash", "clash") for u, t, *_ in CAPTURES]
    captures = spark.createDataFrame(rows, "url string, fetched_at timestamp, key string, matches string")
    entries = spark.createDataFrame(ENTRIES, "list string, key string, action string, dated date")
    found = url_lists.judge(captures, entries.withColumn("valid_from", F.lit("clash")))
    got = [(r["url"], r["fetched_at"], r["blocked"], r["matches"]) for r in found.collect()]
    want = [(u, dt.datetime(*t, 12) if t else None, b, m) for u, t, b, m in CAPTURES]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert url_lists.judge(captures, entries.limit(0)).filter("blocked").count() == 0
    assert url_lists.judge(captures.limit(0), entries).count() == 0


PATH_ENTRIES = ["Mixed.org/Dir", "deep.org/a/B/c", "example.org/x", "slash.org/d//", "twice.org//a", "port.org/p/q"]
PATH_CAPTURES = {
    "http://mixed.org/Dir/page": "mixed.org/Dir",
    "http://MIXED.org/Dir": "mixed.org/Dir",
    "http://mixed.org/dir/page": "",
    "http://mixed.org/Directory": "",
    "http://deep.org/a/B/c/d?e": "deep.org/a/B/c",
    "http://deep.org/a/B/c#e": "deep.org/a/B/c",
    "http://deep.org/a/B": "",
    "http://deep.org/a/b/c": "",
    "http://www.example.org/x/y/z/z/z": "example.org/x",
    "http://example.org/?/x": "",
    "http://slash.org/d": "slash.org/d",
    "http://slash.org/d/e": "slash.org/d",
    "http://twice.org//a/b": "twice.org//a",
    "http://twice.org/a": "",
    "http://u@port.org:80/p/q/": "port.org/p/q",
}


def test_paths_of_any_depth_below_hosts_and_domains(spark):
    rows = [(url, dt.datetime(2024, 1, 2, 12)) for url in PATH_CAPTURES]
    captures = spark.createDataFrame(rows, "url string, fetched_at timestamp")
    entries = [("block", key, "add", D(2024, 1, 1)) for key in PATH_ENTRIES]
    found = url_lists.judge(captures, spark.createDataFrame(entries, "list string, key string, action string, dated date"))
    want = {url: (key != "", key and f"block:{key}") for url, key in PATH_CAPTURES.items()}
    assert {r["url"]: (r["blocked"], r["matches"]) for r in found.collect()} == want
