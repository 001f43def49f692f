"""WARC archives and a globally ordered capture index, merged from sorted runs.

Captures are written as WARC files: equal payloads once, as a response, and as revisits
of it after that. Reading an archive gives its captures as a run sorted by URL key and
time. Runs are cut into blocks at splitters of the key space and exchanged once; each task
then merges the runs of its range with a loser tree. Blocks arrive in the order of their
first capture, so that a run is opened only when the merge reaches it, and no more than
one block of a run is held.

Defined cases: a null html is an empty payload. Payloads below ``MIN_BYTES`` are never
revisits. Of equal payloads the smallest page_id is the response, and so is each row that
repeats it; rows without id are revisits of rows with one, and responses if there are
none. A url that is null has the key ''; line breaks in a url are escaped. Captures equal
in key and time go by page_id, null first. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import stored
from kerbside.workspace import scratch

MIN_BYTES = 100
RECORDS_PER_FILE = 20_000
BLOCK_CAPTURES = 512
SAMPLES_PER_RANGE = 32
FIRST_CAPTURE = 1_704_067_200  # 2024-01-01T00:00:00Z
_PACKED_AT_ONCE = 1 << 16
_ORDER = ("url_key", "captured_at", "page_id")
# Fixed values of the format.
_BREAK = "\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = (
    "url_key string, captured_at string, page_id bigint, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, archive string, position bigint, length bigint"
)
_NAMES = [part.split()[0] for part in _CAPTURE.split(", ")]
_BLOCK = f"range int, run string, block int, first_key string, first_at string, first_page bigint, captures array<struct<{_CAPTURE.replace(' ', ': ').replace(',:', ',')}>>"


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then the rest: ``com,example,www)/path``."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)$"
    name = F.lower(F.regexp_extract(url, pattern, 1))
    key = F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), F.lit(")"), F.regexp_extract(url, pattern, 2))
    return F.when(name != "", key).otherwise(F.coalesce(url, F.lit("")))


def captured_at(page_id: Column) -> Column:
    """Where a table has no fetch times: one capture a minute, in the order of ids."""
    seconds = FIRST_CAPTURE + F.coalesce(page_id, F.lit(0)) % 10_000_000 * 60
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, captured_at, html, and the digest and size of the payload."""
    html = F.coalesce("html", F.lit(""))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return pages.select(
        "page_id", url.alias("url"), captured_at(F.col("page_id")).alias("captured_at"), html.alias("html"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("bigint").alias("size"),
    )


def _header(name: str, value: Column | str) -> Column:
    """A header line; null, and so left out, without a value."""
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(_BREAK))


def records(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Each capture as the text of a WARC record, without the two line breaks that end it."""
    many = rows.filter(F.col("size") >= min_bytes).groupBy("digest")
    many = many.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = rows.join(stored(many, "warc-payloads"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html; charset=utf-8{_BREAK}"),
        _header("Content-Length", F.col("size").cast("string")), F.lit(_BREAK),
    )
    body = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html")))

    def name(id_: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(id_).cast("string"), F.lit("none")), F.lit(">"))

    head = F.concat_ws(
        "",
        F.lit(f"WARC/1.1{_BREAK}"),
        _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", name("page_id")),
        _header("WARC-Date", F.col("captured_at")),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(_header("WARC-Refers-To", name("first")), _header("WARC-Profile", _REVISIT))),
        _header("Content-Type", "application/http;msgtype=response"),
        _header("Content-Length", F.octet_length(body).cast("string")),
    )
    return joined.select(F.concat(head, F.lit(_BREAK), body).alias("record"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Compressed WARC files of bounded numbers of records below ``path``, on any file system."""
    writer = records(captures(pages), min_bytes).write.option("lineSep", _BREAK * 2)
    writer.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, block, position and length of each record of an uncompressed archive."""
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split(_BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = end + 4
        stop = begin + int(headers["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it should")
        yield headers, archive[begin:stop], at, stop + 4 - at
        at = stop + 4


def unpack(content: memoryview) -> bytes:
    """What all gzip members of an archive hold, one after the other."""
    out, at, member = [], 0, None
    while at < len(content):
        if member is None:
            if content[at] == 0 and out:  # padding after a member
                at += 1
                continue
            member = zlib.decompressobj(31)
        piece = content[at : at + _PACKED_AT_ONCE]
        out.append(member.decompress(piece))
        at += len(piece) - len(member.unused_data)
        member = None if member.eof else member
    if member is not None:
        raise ValueError("the last gzip member does not reach its end")
    return b"".join(out)


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").rstrip(">")
    return None if number == "none" else int(number)


def _capture(headers: dict[str, str], block: bytes, archive: str, position: int, length: int) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split(_BREAK)[1:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"the payload at byte {position} of {archive} differs from its digest")
    refers = headers.get("WARC-Refers-To")
    return {
        "captured_at": headers["WARC-Date"], "page_id": _page(headers["WARC-Record-ID"]),
        "url": headers.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": int(fields["Content-Length"]),
        "payload_digest": digest, "refers_to": _page(refers) if refers else None,
        "archive": archive, "position": position, "length": length,
    }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures in the archives below ``path``, payloads checked against their digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [name for name in _NAMES if name != "url_key"]
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                unpacked = unpack(memoryview(content.as_buffer()).cast("B"))
                found = [_capture(h, block, name, at, n) for h, block, at, n in parse(unpacked)]
                yield pa.RecordBatch.from_arrays([pa.array([c[x] for c in found], _TYPES[x]) for x in schema], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    columns = _CAPTURE.removeprefix("url_key string, ")
    return files.mapInArrow(read, columns).withColumn("url_key", url_key(F.col("url"))).select(*_NAMES)


_TYPES = {name: pa.int64() if kind == "bigint" else pa.string() for name, kind in (p.split() for p in _CAPTURE.split(", "))}


def _sort_key(capture: dict) -> tuple:
    page = capture["page_id"]
    return capture["url_key"], capture["captured_at"], -1 << 63 if page is None else page


def sorted_runs(found: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Per task one run, sorted, as blocks that end at splitters."""
    from bisect import bisect_right

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((row for batch in batches for row in batch.to_pylist()), key=_sort_key)
        context = TaskContext.get()
        run = f"run-{context.partitionId() if context else 0:08d}"
        blocks, start = [], 0
        while start < len(rows):
            range_ = bisect_right(splitters, _sort_key(rows[start]))
            end = min(start + BLOCK_CAPTURES, len(rows))
            while bisect_right(splitters, _sort_key(rows[end - 1])) != range_:
                end -= max(1, (end - start) // 2) if end - start > 2 else 1
            first = rows[start]
            blocks.append((range_, run, len(blocks), *(first[c] for c in _ORDER), rows[start:end]))
            start = end
        names = ["range", "run", "block", "first_key", "first_at", "first_page", "captures"]
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64()]
        kinds.append(pa.list_(pa.struct([(n, _TYPES[n]) for n in _NAMES])))
        for i in range(0, len(blocks), 64):
            columns = zip(*blocks[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    return found.mapInArrow(cut, _BLOCK)


class LoserTree:
    """A tournament of cursors: inner nodes keep the loser of their match, so that replacing
    the winner takes one match per level."""

    def __init__(self, cursors: list):
        self.cursors = cursors
        self.losers = [0] * len(cursors)
        self.winner = self._play(1)

    def _beats(self, a: int, b: int) -> bool:
        return self.cursors[a].key <= self.cursors[b].key

    def _play(self, node: int) -> int:
        n = len(self.cursors)
        if node >= n:
            return node - n
        left, right = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(left, right):
            left, right = right, left
        self.losers[node] = right
        return left

    def replay(self) -> None:
        """The winner's key has changed: it plays its way up again."""
        winner = self.winner
        node = (winner + len(self.cursors)) // 2
        while node:
            if not self._beats(winner, self.losers[node]):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.winner = winner


class _Cursor:
    """A block of a run, and the key of the capture it is at; above all keys when it ends."""

    END = (chr(0x10FFFF) * 2,)

    def __init__(self, captures: list[dict]):
        self.captures, self.at = captures, 0
        self.key = _sort_key(captures[0])

    def take(self) -> dict:
        capture = self.captures[self.at]
        self.at += 1
        self.key = _sort_key(self.captures[self.at]) if self.at < len(self.captures) else self.END
        return capture


def merge_blocks(blocks: Iterator[list[dict]]) -> Iterator[dict]:
    """Captures in order, from blocks in the order of their first capture."""
    tree = None
    ahead = next(blocks, None)
    while tree is not None or ahead is not None:
        if ahead is not None and (tree is None or _sort_key(ahead[0]) <= tree.cursors[tree.winner].key):
            live = [c for c in tree.cursors if c.key != _Cursor.END] if tree else []
            tree = LoserTree([*live, _Cursor(ahead)])
            ahead = next(blocks, None)
            continue
        cursor = tree.cursors[tree.winner]
        if cursor.key == _Cursor.END:
            tree = None
            continue
        yield cursor.take()
        tree.replay()


def merged(runs: DataFrame, ranges: int) -> DataFrame:
    """All captures in global order: by ``range``, and within it by ``place``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple[int, list[dict]]]:
            for batch in batches:
                yield from zip(batch.column("range").to_pylist(), (x.as_py() for x in batch.column("captures")))

        rows, range_ = [], None
        source = blocks()
        held = next(source, None)

        def of_range() -> Iterator[list[dict]]:
            nonlocal held
            while held is not None and held[0] == range_:
                block = held[1]
                held = next(source, None)
                yield block

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r[n] for r in rows], _TYPES[n]) for n in _NAMES]
            places = [pa.array([range_] * len(rows), pa.int32()), pa.array(range(place - len(rows), place), pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, *places], [*_NAMES, "range", "place"])

        while held is not None:
            range_, place = held[0], 0
            for capture in merge_blocks(of_range()):
                rows.append(capture)
                place += 1
                if len(rows) == 4096:
                    yield batch()
                    rows.clear()
            yield batch()
            rows.clear()

    dealt = runs.repartitionById(ranges, F.col("range"))
    ordered = dealt.sortWithinPartitions("range", "first_key", "first_at", F.asc_nulls_first("first_page"), "run", "block")
    return ordered.mapInArrow(merge, f"{_CAPTURE}, range int, place bigint")


def capture_history(spark: SparkSession, path: str, ranges: int | None = None) -> DataFrame:
    """The captures in the archives below ``path``, globally ordered.

    Splitters come from a sample of the keys, of ``SAMPLES_PER_RANGE`` keys a range; they
    only balance the ranges. All captures of one URL may be divided, by time.
    """
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stored(read_archives(spark, path), "warc-captures")
    keys = found.select(*_ORDER).orderBy(F.xxhash64(*_ORDER)).limit(ranges * SAMPLES_PER_RANGE).toArrow().to_pylist()
    sample = sorted(map(_sort_key, keys))
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    return merged(sorted_runs(found, splitters), len(splitters) + 1)


def archive_history(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages written as archives, read back and merged."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    return capture_history(pages.sparkSession, path)
