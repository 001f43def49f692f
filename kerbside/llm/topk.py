"""Exact top-k by inner product with MaxScore.

Vectors become integers. Candidates are packed into shards of bounded size whose columns
are the postings of the terms (dimensions); queries are packed into blocks. For each block
and shard a query's terms are ordered by the most they can add. Terms whose bounds
together stay below the k-th best score so far are non-essential: candidates are scored on
the essential ones, and the others are probed only for those that can still compete. The
best of all shards are merged.

Defined cases: a vector that is null or empty, or holds a null, NaN or infinity, takes no part;
nor does a row without id. Shorter vectors count as padded with zeros. A query's own row
is the one with its id; rows that repeat an id are one query (the smallest vector) but
candidates each. Equal scores go to the smaller id. Fewer candidates than k give fewer
rows; no rows give no rows. Scores have to fit into 64 bits. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import numbered, stored

K = 10
SCALE = 1024
QUERY_EVERY = 100
SHARD_ROWS = 4096
BLOCK_ROWS = 256
STRIDE = 1024
_PACKED = "n int, ids binary, cells binary"


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _pack(rows: DataFrame, at_once: int) -> DataFrame:
    """Rows (id, cells) to blocks of at most ``at_once`` rows, by task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []

        def block() -> pa.RecordBatch:
            width = max(map(len, vectors))
            cells = np.zeros((len(ids), width), dtype=np.int64)
            for row, vector in zip(cells, vectors):
                row[: len(vector)] = vector
            columns = [pa.array([len(ids)], pa.int32()), pa.array([np.array(ids, dtype=np.int64).tobytes()])]
            return pa.RecordBatch.from_arrays([*columns, pa.array([cells.tobytes()])], ["n", "ids", "cells"])

        for batch in batches:
            cells = batch.column("cells")
            values, ends = cells.values.to_numpy(), cells.offsets.to_numpy()
            for i, id_ in enumerate(batch.column("id").to_pylist()):
                ids.append(id_)
                vectors.append(values[ends[i] : ends[i + 1]])
                if len(ids) == at_once:
                    yield block()
                    ids.clear()
                    vectors.clear()
        if ids:
            yield block()

    return rows.mapInArrow(pack, _PACKED)


class Shard:
    """Candidates with a contiguous posting list per term."""

    def __init__(self, ids: np.ndarray, cells: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, cells = ids[order], cells[order]
        self.postings = np.ascontiguousarray(cells.T)
        self.most, self.least = cells.max(axis=0), cells.min(axis=0)

    def best(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id)."""
        width = min(len(query), len(self.postings))
        query = query[:width]
        bounds = np.maximum(query * self.most[:width], query * self.least[:width])
        terms = np.argsort(-bounds, kind="stable")
        # What the terms from the i-th on can add at most; a negative bound lowers it.
        rest = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)
        scores, ids, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for start in range(0, len(self.ids), STRIDE):
            span = slice(start, min(start + STRIDE, len(self.ids)))
            # Terms from ``essential`` on cannot reach the k-th score by themselves.
            reaching = [] if floor is None else np.flatnonzero(rest < floor)
            essential = max(1, int(reaching[0])) if len(reaching) else width
            lists = self.postings[terms[:essential], span]
            score = query[terms[:essential]] @ lists
            alive = np.flatnonzero(self.ids[span] != own)
            if floor is not None:
                alive = alive[score[alive] + rest[essential] >= floor]
            score = score[alive]
            for term in range(essential, width):
                if not len(alive):
                    break
                score = score + query[terms[term]] * self.postings[terms[term], start + alive]
                keep = score + rest[term + 1] >= floor
                alive, score = alive[keep], score[keep]
            scores, ids = np.append(scores, score), np.append(ids, self.ids[span][alive])
            if len(scores) > k:
                top = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[top], ids[top]
            if len(scores) == k:
                floor = scores.min()
        return list(zip(scores.tolist(), ids.tolist()))


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids, cells = (np.frombuffer(row[name], dtype=np.int64) for name in ("ids", "cells"))
    return ids, cells.reshape(row["n"], -1)


def _scores(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Per shard, its row first and then those of query blocks: the k best for each query."""
    shard = None
    for batch in batches:
        for row in batch.to_pylist():
            if not row["is_block"]:
                shard = Shard(*_matrix(row))
                continue
            found = [
                (int(own), id_, value)
                for own, query in zip(*_matrix(row))
                for value, id_ in shard.best(own, query, k)
            ]
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query; both have (id, cells)."""
    shards = numbered(_pack(candidates, SHARD_ROWS), "shard", "topk-shards")
    first = queries.groupBy("id").agg(F.min("cells").alias("cells"))
    blocks = stored(_pack(first, BLOCK_ROWS), "topk-queries")
    # Every block is dealt to every shard, and reaches it after the shard itself.
    last = F.lit(max(0, shards.count() - 1)).cast("bigint")
    dealt = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    rows = shards.withColumn("is_block", F.lit(False)).unionByName(dealt.withColumn("is_block", F.lit(True)))
    together = rows.repartition("shard").sortWithinPartitions("shard", "is_block")
    found = together.mapInArrow(lambda batches: _scores(batches, k), "query_id bigint, vec_id bigint, score bigint")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", best).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Top k of all rows for the rows whose id is divisible by ``every``."""
    rows = vectors.filter(F.col(id_).isNotNull() & valid(F.col(vector)))
    rows = rows.select(F.col(id_).alias("id"), integers(F.col(vector)).alias("cells"))
    return search(rows.filter(F.col("id") % every == 0), rows, k)
