"""Ranked lexical search with Block-Max MaxScore.

An index shard holds some thousands of documents: per term the documents and frequencies in
compressed blocks, and per block the pairs of frequency and document length that no other
pair of the block beats. A score grows with the frequency and falls with the length, so
these pairs give the largest score in a block exactly, whatever the statistics of the whole
collection turn out to be, and without unpacking the block.

Every task scores all queries on its shards in turn and carries the k-th best score of each
on. Of a query's terms, those whose bounds over their whole list together stay below that
score are non-essential: documents come from the lists of the others only. They are then
looked up in the non-essential lists, largest bound first, as long as they can still
compete; a block is unpacked only for documents that its maximum lets through. The best of
all tasks are merged.

Postings are not shuffled, since a shard holds what its task has read. Only terms that the
queries have are indexed, if there are at most ``VOCABULARY`` of them; else all are. Queries
go to the tasks in blocks of about ``QUERY_ROWS`` terms, each a pass over the index.

Defined cases: a null or empty text has no terms, and takes no part. Rows that repeat an id
are documents each. A null id comes after all others on a tie. Items that share an id are
one query of all their terms; an item without terms, or with unknown ones only, has no
results. Columns other than the ids and texts are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kerbside.llm.common import UPPER, pieces, small_batches, spaced, stored, text_of

K = 20
SHARD_DOCUMENTS = 2048
SHARD_BYTES = 8 << 20
BLOCK_POSTINGS = 64
VOCABULARY = 1_000_000
QUERY_ROWS = 200_000
# Fixed value: what terms are made of.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SHARD = (
    "documents bigint, words bigint, ids binary, lengths binary, terms array<binary>, dfs array<bigint>, "
    "firsts binary, bests binary, sizes binary, postings binary"
)


# -- codes ---------------------------------------------------------------------------


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers in groups of 7 bits, lowest first, and the number of bytes of each."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        sizes += values >= np.uint64(1 << bits)
    ends = np.cumsum(sizes)
    code = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for group in range(int(sizes.max()) if len(sizes) else 0):
        has = sizes > group
        part = (values[has] >> np.uint64(7 * group)) & np.uint64(127)
        more = (sizes[has] > group + 1).astype(np.uint64) << np.uint64(7)
        code[ends[has] - sizes[has] + group] = part | more
    return code, sizes


def unpacked(code: np.ndarray) -> np.ndarray:
    """The integers of a code."""
    if not len(code):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(code < 128)
    starts = np.append(0, ends[:-1] + 1)
    place = np.arange(len(code)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((code & 127).astype(np.int64) << (7 * place), starts)


# -- index ----------------------------------------------------------------------------


class _Builder:
    """Documents of a shard to be."""

    def __init__(self, vocabulary: frozenset[bytes] | None):
        self.vocabulary = vocabulary
        self.known: dict[bytes, int] = {}
        self.ids, self.lengths, self.terms, self.counts, self.per_document = [], [], [], [], []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        counts: Counter[bytes] = Counter()
        for piece in pieces(spaced(text)):
            counts.update(piece.split())
        if not counts:
            return
        found = counts.keys() if self.vocabulary is None else counts.keys() & self.vocabulary
        self.ids.append(doc_id)
        self.lengths.append(counts.total())
        self.terms += [self.known.setdefault(term, len(self.known)) for term in found]
        self.counts += [counts[term] for term in found]
        self.per_document.append(len(found))
        self.size += len(text)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCUMENTS or self.size >= SHARD_BYTES

    def batch(self) -> pa.RecordBatch:
        lengths = np.array(self.lengths, np.int64)
        term, tf = np.array(self.terms, np.int64), np.array(self.counts, np.int64)
        document = np.repeat(np.arange(len(lengths)), self.per_document)
        order = np.argsort(term, kind="stable")
        term, tf, document = term[order], tf[order], document[order]
        dfs = np.bincount(term, minlength=len(self.known))
        # Blocks of a list are full but for its last.
        place = np.arange(len(term)) - np.repeat(np.cumsum(dfs) - dfs, dfs)
        opens = place % BLOCK_POSTINGS == 0
        block = np.cumsum(opens) - 1
        step = np.where(opens, 0, np.diff(document, prepend=0))
        code, sizes = packed(np.stack([step, tf], axis=1).ravel())
        sizes = sizes.reshape(-1, 2).sum(axis=1)
        n_blocks = int(opens.sum())
        best = _unbeaten(block, tf, lengths[document])
        bests = np.stack([np.bincount(block[best], minlength=n_blocks)[block[best]], tf[best], lengths[document][best]], axis=1)
        ids = pa.array(self.ids, pa.int64())
        columns = {
            "documents": pa.array([len(lengths)], pa.int64()),
            "words": pa.array([int(lengths.sum())], pa.int64()),
            "ids": pa.array([np.concatenate([ids.is_null().to_numpy(False), ids.fill_null(0).to_numpy()]).astype(np.int64).tobytes()]),
            "lengths": pa.array([packed(lengths)[0].tobytes()]),
            "terms": pa.array([list(self.known)], pa.list_(pa.binary())),
            "dfs": pa.array([dfs.tolist()], pa.list_(pa.int64())),
            "firsts": pa.array([packed(document[opens])[0].tobytes()]),
            "bests": pa.array([packed(bests.ravel())[0].tobytes()]),
            "sizes": pa.array([packed(np.bincount(block, sizes, n_blocks).astype(np.int64))[0].tobytes()]),
            "postings": pa.array([code.tobytes()]),
        }
        return pa.RecordBatch.from_pydict(columns)


def _unbeaten(block: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of postings such that none of the same block has a frequency as high in a text as short."""
    if not len(block):
        return np.zeros(0, np.int64)
    order = np.lexsort((-tf, length, block))
    highest = np.maximum.accumulate((block[order] << 40) + tf[order])
    return order[np.append(True, highest[1:] > highest[:-1])]


def index(documents: DataFrame, vocabulary: frozenset[bytes] | None = None) -> DataFrame:
    """Shards of the documents (doc_id, text); of all terms, or those of a vocabulary only."""
    asked = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder(asked.value)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                builder.add(doc_id, text.as_py())
                if builder.full():
                    yield builder.batch()
                    builder = _Builder(asked.value)
        if builder.ids:
            yield builder.batch()

    small_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(build, _SHARD)


# -- search ------------------------------------------------------------------------------


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def relative_length(lengths: np.ndarray, n: int, words: int) -> np.ndarray:
    """Documents' lengths against the average, as the score takes them."""
    if len(lengths) and 25 * int(lengths.max()) * n < 1 << 63:
        return 75 + (25 * lengths * n) // words
    return np.array([75 + (25 * x * n) // words for x in lengths.tolist()], np.int64)


class Shard:
    """A shard of the index under the statistics of the whole collection."""

    def __init__(self, row: dict, n: int, words: int):
        ids = np.frombuffer(row["ids"], np.int64).reshape(2, -1)
        self.without_id, self.ids = ids
        self.m = relative_length(unpacked(np.frombuffer(row["lengths"], np.uint8)), n, words)
        self.numbers = {term: i for i, term in enumerate(row["terms"])}
        dfs = np.array(row["dfs"], np.int64)
        blocks = -(-dfs // BLOCK_POSTINGS)
        # Blocks of the i-th term are those from blocks[i] on.
        self.blocks = np.append(0, np.cumsum(blocks))
        self.firsts = unpacked(np.frombuffer(row["firsts"], np.uint8))
        sizes = unpacked(np.frombuffer(row["sizes"], np.uint8))
        self.bounds = np.append(0, np.cumsum(sizes))
        self.postings = np.frombuffer(row["postings"], np.uint8)
        bests = unpacked(np.frombuffer(row["bests"], np.uint8)).reshape(-1, 3)
        self.most, self.list_most = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(bests):
            opens, at = [], 0
            counts = bests[:, 0].tolist()
            while at < len(counts):
                opens.append(at)
                at += counts[at]
            self.most = np.maximum.reduceat(impact(bests[:, 1], relative_length(bests[:, 2], n, words)), opens)
            self.list_most = np.maximum.reduceat(self.most, self.blocks[:-1])
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of ascending blocks of one term."""
        code = np.concatenate([self.postings[self.bounds[b] : self.bounds[b + 1]] for b in blocks.tolist()])
        pairs = unpacked(code).reshape(-1, 2)
        step = pairs[:, 0].copy()
        # Steps in a block are positive but for its first.
        opens = np.flatnonzero(step == 0)
        total = np.cumsum(step)
        documents = total + np.repeat(self.firsts[blocks] - total[opens], np.diff(np.append(opens, len(step))))
        return documents, impact(pairs[:, 1], self.m[documents])

    def _list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        if term not in self.whole:
            self.whole[term] = self._unpack(np.arange(self.blocks[term], self.blocks[term + 1]))
        return self.whole[term]

    def best(self, query: Sequence[tuple[bytes, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of documents and their scores; all that score at least ``floor`` (1 or more)."""
        lists = [(int(w * self.list_most[self.numbers[t]]), self.numbers[t], w) for t, w in query if t in self.numbers]
        lists = sorted(x for x in lists if x[0] > 0)
        rest = np.cumsum([bound for bound, *_ in lists])  # of a list and all before it
        non_essential = int(np.searchsorted(rest, floor)) if len(rest) else 0
        if non_essential == len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.zeros(len(self.m), np.int64)
        for _, term, w in lists[non_essential:]:
            documents, impacts = self._list(term)
            total[documents] += w * impacts
        alive = np.flatnonzero(total)
        score = total[alive]
        for i in reversed(range(non_essential)):
            keep = score + rest[i] >= floor
            alive, score = alive[keep], score[keep]
            if not len(alive):
                break
            _, term, w = lists[i]
            if term in self.whole:
                documents, impacts = self.whole[term]
            else:
                first, last = self.blocks[term], self.blocks[term + 1]
                block = np.searchsorted(self.firsts[first:last], alive, side="right") - 1
                most = np.where(block >= 0, w * self.most[first + np.maximum(block, 0)], 0)
                keep = score + most + (rest[i - 1] if i else 0) >= floor
                alive, score, block = alive[keep], score[keep], block[keep]
                needed = np.unique(block[block >= 0])
                if not len(needed):
                    continue
                documents, impacts = self._unpack(first + needed)
            place = np.minimum(np.searchsorted(documents, alive), len(documents) - 1)
            score = score + np.where(documents[place] == alive, w * impacts[place], 0)
        keep = score >= floor
        return alive[keep], score[keep]


class _Heap:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.rows = np.zeros((3, 0), np.int64)  # score, without id, id

    def add(self, shard: Shard, places: np.ndarray, scores: np.ndarray) -> None:
        rows = np.concatenate([self.rows, [scores, shard.without_id[places], shard.ids[places]]], axis=1)
        if rows.shape[1] > self.k:
            rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]
        self.rows = rows
        if rows.shape[1] == self.k:
            self.floor = max(1, int(rows[0].min()))


def _pass(shards: DataFrame, queries: list, item_type, n: int, words: int, k: int) -> DataFrame:
    """The k best documents of each task for the queries (item, list of terms and weights)."""
    asked = shards.sparkSession.sparkContext.broadcast(queries)
    kind = to_arrow_type(item_type)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [_Heap(k) for _ in asked.value]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], n, words)
                for heap, (_, query) in zip(heaps, asked.value):
                    places, scores = shard.best(query, heap.floor)
                    if len(places):
                        heap.add(shard, places, scores)
        for heap, (item, _) in zip(heaps, asked.value):
            score, without_id, ids = heap.rows
            doc_id = pa.array(ids, pa.int64(), mask=without_id.astype(bool))
            columns = [pa.array([item] * len(ids), kind), doc_id, pa.array(score, pa.int64())]
            if len(ids):
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    schema = f"item_id {item_type.simpleString()}, doc_id bigint, score bigint"
    return shards.mapInArrow(search, schema)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(TERM), F.lit(0))


def search(documents: DataFrame, items: DataFrame, k: int = K, vocabulary: int = VOCABULARY) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents (doc_id, text) for each item (item_id, text)."""
    spark = documents.sparkSession
    rows = items.select("item_id", F.explode(terms(text_of())).alias("term"))
    query_terms = stored(rows.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats")), "search-queries")
    distinct = query_terms.select(F.col("term").cast("binary").alias("term")).distinct()
    # A bounded set of terms goes to the tasks; of more terms, all of the documents are indexed.
    asked = frozenset(bytes(row.term) for row in distinct.limit(vocabulary + 1).toLocalIterator())
    small_batches(spark, size=32 << 20)
    shards = stored(index(documents, asked if len(asked) <= vocabulary else None), "search-index")
    totals = shards.agg(F.sum("documents").alias("n"), F.sum("words").alias("words")).first()
    n, words = totals.n or 0, totals.words or 0
    each = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select("x.terms", "x.dfs")
    known = each.groupBy(F.col("terms").cast("string").alias("term")).agg(F.sum("dfs").alias("df"))
    weighted = query_terms.join(known, "term")
    passes = max(1, -(-query_terms.count() // QUERY_ROWS))
    if passes > 1:
        weighted = stored(weighted, "search-weighted")
    item_type = items.schema["item_id"].dataType
    found = []
    for number in range(passes):
        block = F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number
        queries = defaultdict(list)
        for row in weighted.filter(block).toLocalIterator():
            queries[row.item_id].append((row.term.encode(), row.repeats * weight(n, row.df)))
        found.append(_pass(shards, list(queries.items()), item_type, n, words, k))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = every.withColumn("rank", best).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
