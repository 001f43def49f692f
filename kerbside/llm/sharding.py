"""Shards of near equal bytes by histogram sort.

Every document gets a 64-bit key: 40 bits of a hash of its text, then 24 of its id, so
that equal texts lie side by side. Boundaries between shards are sought by counting the
exact bytes below candidate keys over all partitions, and probing again between the two
nearest, until each is within tolerance. Then the documents are exchanged once, straight
to their places. Boundaries between texts are tried first; a group of equal texts is
divided only where it alone is larger than the tolerance.

Defined cases: a null text has no bytes; its size is 1. Repeated rows have the same key and
stay together. No rows give no rows, and
shards may be empty. Extra columns are carried along; of columns that bear the name of
one computed here, the computed one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored, text_of

SHARDS = 16
TOLERANCE = 0.01
PART_BYTES = 128 << 20
PROBES = 24
_ID_BITS = 24
_LOW, _HIGH = -(1 << 63), 1 << 63
ADDED = ("size", "shard", "slot")


def _keyed(documents: DataFrame) -> DataFrame:
    text_bits = F.xxhash64(text_of()).bitwiseAND(F.lit(-1 << _ID_BITS))
    id_bits = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    size = F.octet_length(text_of()).cast("bigint") + 1
    return documents.drop(*ADDED, "_part").withColumns({"size": size, "_key": text_bits.bitwiseOR(id_bits)})


def _below(keys: DataFrame, probes: list[int]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each probe (sorted). One row per task reaches the sum."""
    edges = np.array(probes, dtype=np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros((2, len(edges) + 1), dtype=np.int64)
        for batch in batches:
            bin_ = np.searchsorted(edges, batch.column("_key").to_numpy(), side="right")
            np.add.at(size, bin_, batch.column("size").to_numpy())
            rows += np.bincount(bin_, minlength=len(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(size))), pa.array(size), pa.array(rows)], ["bin", "size", "rows"]
        )

    bins = keys.mapInArrow(count, "bin bigint, size bigint, rows bigint").groupBy("bin")
    found = {r[0]: (r[1], r[2]) for r in bins.agg(F.sum("size"), F.sum("rows")).collect()}
    counts = np.cumsum([found.get(i, (0, 0)) for i in range(len(edges))], axis=0)
    return [(int(s), int(n)) for s, n in counts]


def splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE) -> tuple[list[int], list[int]]:
    """Keys that divide (_key, size) into ``parts`` of near equal size, and the rows below each."""
    whole = keys.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, rows = whole[0] or 0, whole[1]
    ends = {_LOW: (0, 0), _HIGH: (total, rows)}
    goals = [total * i / parts for i in range(1, parts)]
    slack = tolerance * total / parts
    spans = [(_LOW, _HIGH)] * len(goals)
    while True:
        chosen, probes = [], set()
        for i, goal in enumerate(goals):
            low, high = spans[i]
            best = min(low, high, key=lambda key: abs(ends[key][0] - goal))
            chosen.append(best)
            if abs(ends[best][0] - goal) > slack and high - low > 1:
                # Between texts as long as there is room, then within one.
                step = 1 << _ID_BITS if high - low > 1 << _ID_BITS else 1
                room = (high - low) // step
                marks = range(1, room) if room <= PROBES else [room * j // (PROBES + 1) for j in range(1, PROBES + 1)]
                probes |= {low + mark * step for mark in marks}
        if not probes:
            break
        tried = sorted(probes)
        ends |= dict(zip(tried, _below(keys, tried)))
        for i, goal in enumerate(goals):
            inside = [key for key in (*tried, *spans[i]) if spans[i][0] <= key <= spans[i][1]]
            spans[i] = (
                max((key for key in inside if ends[key][0] <= goal), default=spans[i][0]),
                min((key for key in inside if ends[key][0] > goal), default=spans[i][1]),
            )
    return chosen, [ends[key][1] for key in chosen]


def shard(
    documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The documents with size, shard (from 0) and slot (place in the shard, gapless from 0).

    A shard of more than ``part_bytes`` is dealt to several tasks, in order.
    """
    keyed = _keyed(documents)
    keys = stored(keyed.select("_key", "size"), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = shards * max(1, round(total / shards / part_bytes))
    edges, below = splitters(keys, parts, tolerance * parts / shards)
    starts = [0, *below]
    first = [starts[p - p % (parts // shards)] for p in range(parts)]
    inner = np.array([edge for edge in edges if edge < _HIGH], dtype=np.int64)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(inner, key.to_numpy(), side="right").astype(np.int32))

    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    offsets = F.array(*[F.lit(starts[p] - first[p]) for p in range(parts)])
    dealt = keyed.withColumn("_part", part_of("_key")).repartitionById(parts, F.col("_part"))
    ordered = dealt.sortWithinPartitions("_part", "_key", "doc_id")
    return ordered.withColumns(
        {
            "shard": F.floor(F.col("_part") / (parts // shards)).cast("int"),
            "slot": place + offsets[F.col("_part")],
        }
    ).drop("_part", "_key")
