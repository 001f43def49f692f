"""Best-fit packing into sequences of several permitted lengths.

Each task packs the documents of its partition, longest first, so that nothing is
shuffled and no task holds more than a partition. A piece goes to the open bin where it
leaves the least room. If none has room, a bin is opened whose length costs least for
what is still to be packed. In the end each bin shrinks to the shortest permitted length
that holds its contents.

Defined cases: a text that is null or has no words is a piece of 0 words. A document with
more words than the longest sequence is cut into pieces of that length and a rest. Equal
lengths go by id, null first, then by place in the partition; repeated rows are packed
each. No rows give no rows. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import text_of
from kerbside.llm.mixing import word_count

LENGTHS = (512, 1024, 2048, 4096, 8192)
# What a bin of c words costs: c, so much for each sequence, and attention that grows with the square of c.
OPENING = 256.0
ATTENTION = 16_384.0
_SCHEMA = "bin_id bigint, capacity int, used int, start int, doc_id bigint, piece int, first_word bigint, words int"


def bin_cost(length: int) -> float:
    return OPENING + length + length * length / ATTENTION


def pack_lengths(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, cost: Callable[[int], float] = bin_cost):
    """Bins for sizes in falling order, none above the longest length.

    Returns, per size, its bin and where it starts there, and per bin its length and
    what it holds.
    """
    lengths = sorted(lengths)
    left = int(sum(sizes))
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin has room r
    bins, starts, capacity, used = [], [], [], []
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            # Cost per word packed; a bin longer than what is left stays partly empty.
            fit = [c for c in lengths if c >= size]
            room = min(fit, key=lambda c: (cost(c) / max(1, min(c, left)), c))
            bin_ = len(capacity)
            capacity.append(room)
            used.append(0)
        bins.append(bin_)
        starts.append(used[bin_])
        used[bin_] += size
        left -= size
        by_room.setdefault(room - size, []).append(bin_)
        rooms |= 1 << (room - size)
    return bins, starts, [next(c for c in lengths if c >= u) for u in used], used


def pack(documents: DataFrame, lengths: Sequence[int] = LENGTHS, cost: Callable[[int], float] = bin_cost) -> DataFrame:
    """One row per piece: bin_id, capacity and used of its bin, start in it, doc_id, piece (from 0),
    first_word and words (which words of the text it holds)."""
    longest = max(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("doc_id"), b.column("size").to_numpy()) for b in batches]
        if not parts:
            return
        ids = pa.concat_arrays([x for x, _ in parts])
        sizes = np.concatenate([x for _, x in parts])
        pieces = np.maximum(1, -(-sizes // longest))
        row = np.repeat(np.arange(len(sizes)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        words = np.minimum(longest, sizes[row] - piece * longest)
        key = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)[row]
        order = np.lexsort((piece, row, key, -words))
        bins, starts, capacity, used = (np.array(x, dtype=np.int64) for x in pack_lengths(words[order].tolist(), lengths, cost))
        context = TaskContext.get()
        base = context.partitionId() << 33 if context else 0
        columns = [
            pa.array(base + bins), pa.array(capacity[bins], pa.int32()), pa.array(used[bins], pa.int32()),
            pa.array(starts, pa.int32()), ids.take(pa.array(row[order])), pa.array(piece[order], pa.int32()),
            pa.array(piece[order] * longest), pa.array(words[order], pa.int32()),
        ]
        names = ["bin_id", "capacity", "used", "start", "doc_id", "piece", "first_word", "words"]
        yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=50_000)

    rows = documents.select(F.col("doc_id").cast("bigint"), word_count(text_of()).alias("size"))
    return rows.mapInArrow(run, _SCHEMA)
