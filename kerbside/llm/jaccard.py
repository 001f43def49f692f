"""Jaccard join of word n-gram sets by prefixes and tries.

1. Texts with equal sets form a class, known by a 128-bit sum over the set.
2. Document frequencies of all n-grams are counted; one global order puts rare ones first.
3. Similar sets share an element of their prefixes in that order. Prefix elements are
   exchanged by element; those that two classes share, and that lengths and places allow to
   be the first common one, remain.
4. Each class goes to its largest remaining element. The sets that meet there form a trie,
   which is searched for links (see ``prefix_tree``); links become components.
5. Elements whose classes still lie in several components are taken up once more, all of
   them: there every class is compared with those of other components. So no link between
   components is missed, and no pairs are listed within one.

A group too large for one trie is divided into blocks by a hash, and in step 5 every two
blocks meet. What the driver holds is bounded: the ``COMMON`` most frequent n-grams.

Defined cases: a text that is null or has no words has the empty set and is linked with
nothing. A document without id is linked with nothing and has no component. Rows with equal id are one
document, whose texts lie in one component even if they differ. Which row stays is decided by the texts
alone: an id that has several links none of them. No rows give no rows. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import same, small_batches, stored, text_of, tidy
from kerbside.llm.prefix_tree import links, needed
from kerbside.llm.shingles import gram_sets, mixed
from kerbside.operators.joins import lookup_join

WORDS = 5
PERCENT = 75
COMMON = 1 << 22
GROUP = 1024
_COUNTED_AT_ONCE = 1 << 20
_LISTED_AT_ONCE = 1 << 18
# An element in so many documents is dealt to several tasks.
_SALTED = 1 << 16
_PAIRED = 64
_SET = ["n", "s1", "s2"]


def _signature(grams: np.ndarray) -> tuple[int, int, int]:
    sums = [mixed(grams, salt).sum(dtype=np.uint64).astype(np.int64) for salt in (0x51, 0x52)]
    return len(grams), int(sums[0]), int(sums[1])


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def text_digest() -> Column:
    return F.unhex(F.sha2(text_of(), 256))


def signatures(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_digest, n (size of the set), s1 and s2 (the set, in 128 bits)."""
    schema = "doc_id bigint, text_digest binary, n bigint, s1 bigint, s2 bigint"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signature(s) for _, _, sets in gram_sets(batch, words) for s in sets]
            own = [batch.column("doc_id"), batch.column("text_digest")]
            yield _batch([*own, *(zip(*found) if found else ([], [], []))], schema)

    return documents.select("doc_id", "text", text_digest().alias("text_digest")).mapInArrow(tidy(sign), schema)


def _parts(documents: DataFrame) -> int:
    return int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def common_grams(documents: DataFrame, words: int = WORDS, most: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (sorted) and document frequencies of the most frequent n-grams, ``most`` at most.

    Every n-gram of every text is counted, by 32 bits of its hash within a part. The order
    that follows from it needs no exact counts, only the same ones for all sets.
    """
    parts = _parts(documents)
    schema = "part int, grams binary"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            keys = np.sort(_fingerprints(np.concatenate(held), parts))
            cuts = np.searchsorted(keys >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
            low = keys.astype(np.uint32)
            some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
            return _batch([some, [low[cuts[p] : cuts[p + 1]].tobytes() for p in some]], schema)

        for batch in batches:
            for _, _, sets in gram_sets(batch, words):
                held += sets
                n += sum(map(len, sets))
                if n >= _COUNTED_AT_ONCE:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, part = [], None
        for batch in batches:
            blobs += [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in batch.column("grams")]
            part = batch.column("part")[0].as_py() if len(batch) else part
        if blobs:
            grams, df = np.unique(np.concatenate(blobs), return_counts=True)
            keep = df >= 3
            keys = (np.uint64(part) << np.uint64(32)) | grams[keep].astype(np.uint64)
            yield _batch([keys.astype(np.int64), df[keep]], "key bigint, df bigint")

    dealt = documents.mapInArrow(tidy(deal), schema).repartitionById(parts, F.col("part"))
    counts = dealt.mapInArrow(tidy(count), "key bigint, df bigint")
    level = F.floor(F.log2("df") * 8)
    counts = stored(counts.withColumn("level", level), "jaccard-frequencies")
    least, rows = None, 0
    for row in sorted(counts.groupBy("level").count().collect(), reverse=True):
        rows += row[1]
        if rows > most:
            break
        least = row[0]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.filter(F.col("level") >= least).select("key", "df").toArrow()
    keys, df = found.column("key").to_numpy().astype(np.uint64), found.column("df").to_numpy()
    order = np.argsort(keys)
    return keys[order], df[order]


def _fingerprints(grams: np.ndarray, parts: int) -> np.ndarray:
    return (grams % np.uint64(parts) << np.uint64(32)) | (grams >> np.uint64(32))


def _frequencies(grams: np.ndarray, common: tuple[np.ndarray, np.ndarray], parts: int) -> np.ndarray:
    keys, df = common
    if not len(keys):
        return np.zeros(len(grams), dtype=np.int64)
    wanted = _fingerprints(grams, parts)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, df[at], 0)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Sets similar to one of size n share one of so many first elements with it."""
    return n - -(-percent * n // 100) + 1


_ENTRY = "gram bigint, s1 bigint, n bigint, place bigint"


def shared_prefixes(
    documents: DataFrame, common: tuple[np.ndarray, np.ndarray] | Broadcast, words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Prefix elements (gram, s1, n, place) that may be the first common one of similar sets.

    ``common`` is what ``common_grams`` gives, or a broadcast of it.
    """
    parts = _parts(documents)
    schema = "part int, grams binary, sets binary, sizes binary, places binary"
    if not isinstance(common, Broadcast):
        common = documents.sparkSession.sparkContext.broadcast(common)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, seen = [], 0, set()

        def flush() -> pa.RecordBatch:
            grams, df, sets, sizes, places = (np.concatenate(x) for x in zip(*held))
            # Elements in very many documents are dealt by set, too, and marked.
            salts = np.maximum(1, df // _SALTED).astype(np.uint64)
            spread = np.where(salts > 1, mixed(sets, 0x53) % salts, 0)
            places = np.where(salts > 1, places | 1 << 31, places).astype(np.uint32)
            part = ((grams + spread * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            columns = [x[order] for x in (grams, sets, sizes.astype(np.uint32), places)]
            some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
            return _batch([some, *([c[cuts[p] : cuts[p + 1]].tobytes() for p in some] for c in columns)], schema)

        for batch in batches:
            for _, _, sets in gram_sets(batch, words):
                lengths = [len(s) for s in sets]
                df = _frequencies(np.concatenate(sets), common.value, parts)
                for grams, own in zip(sets, np.split(df, np.cumsum(lengths)[:-1])):
                    size, s1, s2 = _signature(grams)
                    if not size or (s1, s2) in seen:
                        continue
                    seen.add((s1, s2))
                    k = prefix_length(size, percent)
                    first = np.lexsort((grams, own))[:k]
                    key = np.full(k, s1, dtype=np.int64).view(np.uint64)
                    held.append((grams[first], own[first], key, np.full(k, size), np.arange(k)))
                    n += k
                if n >= _LISTED_AT_ONCE:
                    yield flush()
                    held, n, seen = [], 0, set()
        if n:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"grams": np.uint64, "sets": np.uint64, "sizes": np.uint32, "places": np.uint32}
        blobs: dict[str, list] = {name: [] for name in kinds}
        for batch in batches:
            for name, kind in kinds.items():
                blobs[name] += [np.frombuffer(x.as_buffer(), dtype=kind) for x in batch.column(name)]
        if not blobs["grams"]:
            return
        grams, sets, sizes, places = (np.concatenate(x) for x in blobs.values())
        order = np.lexsort((sets, sizes, grams))
        grams, sets, sizes, places = grams[order], sets[order], sizes[order].astype(np.int64), places[order]
        new = np.append(True, (grams[1:] != grams[:-1]) | (sets[1:] != sets[:-1]) | (sizes[1:] != sizes[:-1]))
        grams, sets, sizes, places = grams[new], sets[new], sizes[new], places[new]
        kept = may_match(grams, sizes, (places & 0x7FFFFFFF).astype(np.int64), percent) | (places >> 31 == 1)
        columns = [grams[kept].view(np.int64), sets[kept].view(np.int64), sizes[kept], places[kept] & 0x7FFFFFFF]
        for i in range(0, len(columns[0]), 100_000):
            yield _batch([c[i : i + 100_000] for c in columns], _ENTRY)

    dealt = documents.mapInArrow(tidy(deal), schema).repartitionById(parts, F.col("part"))
    return dealt.mapInArrow(tidy(meet), _ENTRY)


def may_match(grams: np.ndarray, sizes: np.ndarray, places: np.ndarray, percent: int) -> np.ndarray:
    """Which entries, sorted by element and size, have another of their element that sizes and
    places allow to be similar. Elements with more than ``_PAIRED`` entries keep all."""
    begins = np.append(True, grams[1:] != grams[:-1])
    number = np.cumsum(begins) - 1
    count = np.bincount(number)[number]
    kept = count > _PAIRED
    small = np.flatnonzero((count > 1) & ~kept)
    for step in range(1, _PAIRED):
        small = small[small + step < len(grams)]
        a, b = small, small + step
        together = number[a] == number[b]
        small = a = a[together]
        b = b[together]
        if not len(a):
            break
        fits = 100 * sizes[a] >= percent * sizes[b]
        reach = 1 + np.minimum(sizes[a] - places[a], sizes[b] - places[b]) - 1
        fits &= reach >= needed(sizes[a], sizes[b], percent)
        kept[a[fits]] = True
        kept[b[fits]] = True
    return kept


def _linked(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within groups (gram, i, j) of (class, component), found by tries."""
    schema = "a bigint, b bigint"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                keys = zip(*(batch.column(c).to_pylist() for c in ("gram", "i", "j", "class", "component")))
                for (gram, i, j, class_, component), grams in zip(keys, batch.column("grams")):
                    yield (gram, i, j), class_, component, np.frombuffer(grams.as_py(), dtype=np.uint64)

        def close() -> list[tuple[int, int]]:
            if len(set(components)) < 2:
                return []
            return [(classes[a], classes[b]) for a, b in links(members, components, percent)]

        group, classes, components, members, found = None, [], [], [], []
        for key, class_, component, grams in rows():
            if key != group:
                found += close()
                group, classes, components, members = key, [], [], []
            classes.append(class_)
            components.append(component)
            members.append(grams)
        found += close()
        if found:
            yield _batch(list(zip(*found)), schema)

    by = ["gram", "i", "j"]
    groups = stored(groups, "jaccard-groups")
    together = lookup_join(sets, groups, ["class"]).repartition(*by).sortWithinPartitions(*by, "class")
    return stored(together.mapInArrow(tidy(search), schema), "jaccard-links")


def _blocks(size: Column) -> Column:
    return F.ceil(size / GROUP).cast("int")


def _block(size: Column) -> Column:
    return F.pmod(F.xxhash64("class"), _blocks(size)).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """class, component (smallest class reachable) of all classes in edges (a, b).

    Each round hangs every class on the smallest of its neighbours, first those above it,
    then those below, until nothing changes. Its result is written, and a class with many
    neighbours is a minimum with partial sums and a join that can be split.
    """

    def checksum(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # b is the smaller end from here on.
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    edges, before = stored(edges, "components"), None
    while (now := checksum(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.filter("b > a").join(stored(least, "components-least"), "a")
        edges = stored(large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "components")
        least = stored(edges.groupBy("a").agg(F.min("b").alias("least")), "components-least")
        small = edges.join(least, "a")
        moved = small.filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(moved.union(least.select("a", F.col("least").alias("b"))).distinct(), "components")
    return edges.select(F.col("a").alias("class"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def _with_component(frame: DataFrame, found: DataFrame) -> DataFrame:
    joined = frame.join(found, "class", "left")
    return joined.withColumn("component", F.coalesce("component", "class"))


def _united(found: DataFrame, classes: DataFrame, named: DataFrame, several: DataFrame) -> DataFrame:
    """The components when the sets of each id in ``several`` are linked, too."""
    own = lookup_join(named, several, ["doc_id"]).select("doc_id", *_SET).distinct()
    own = stored(own.join(classes, _SET).select("doc_id", "class"), "jaccard-own-sets")
    least = own.groupBy("doc_id").agg(F.min("class").alias("b"))
    edges = own.join(least, "doc_id").select(F.col("class").alias("a"), "b")
    return components(edges.union(found.select(F.col("class").alias("a"), F.col("component").alias("b"))))


def join(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_digest, n_shingles, class_id (smallest id with an equal set), component_id and kept of every row.

    ``kept`` leaves one text of each component of texts, of the smallest id; rows of that id and text
    have it all. Rows without id or words have it, too.
    """
    small_batches(documents.sparkSession)
    documents = documents.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    members = stored(signatures(documents, words), "jaccard-members")
    named = members.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        named.groupBy(*_SET)
        .agg(F.min(F.struct("doc_id", "text_digest")).alias("top"))
        .select(*_SET, F.col("top.doc_id").alias("first"), "top", F.monotonically_increasing_id().alias("class")),
        "jaccard-classes",
    )
    named_documents = documents.filter("doc_id IS NOT NULL")
    common = documents.sparkSession.sparkContext.broadcast(common_grams(named_documents, words))
    entries = shared_prefixes(named_documents, common, words, percent)
    entries = entries.join(classes.select("s1", "n", "class"), ["s1", "n"]).select("gram", "class")
    entries = stored(entries, "jaccard-entries")
    common.unpersist()  # on the executors; a task that is run again gets it anew
    sets = _active_sets(named_documents, classes, entries, words)

    sizes = stored(entries.groupBy("gram").agg(F.count(F.lit(1)).alias("size")), "jaccard-sizes")
    largest = entries.join(sizes, "gram").groupBy("class").agg(F.max(F.struct("size", "gram")).alias("top"))
    own = largest.select(
        F.col("top.gram").alias("gram"), _block(F.col("top.size")).alias("i"), F.lit(0).alias("j"), "class",
        F.col("class").alias("component"),
    )
    first_links = _linked(own, sets, percent)
    found = stored(components(first_links), "jaccard-components")

    placed = stored(_with_component(entries, found), "jaccard-placed")
    open_ = placed.groupBy("gram").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"),
        F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("members"),
    ).filter("low < high")
    # Elements with the same classes are one group.
    open_ = stored(open_.groupBy("members", "size").agg(F.min("gram").alias("gram")).select("gram", "size"), "jaccard-open")
    other = F.explode(F.sequence(F.lit(0), _blocks(F.col("size")) - 1))
    met = placed.join(open_, "gram").withColumns({"block": _block(F.col("size")), "other": other})
    met = met.select("gram", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "class", "component")
    last_links = _linked(met, sets, percent)
    found = stored(components(first_links.union(last_links)), "jaccard-components")

    placed = _with_component(classes, found)
    smallest = stored(placed.groupBy("component").agg(F.min("top").alias("keep")), "jaccard-smallest")
    placed = placed.join(smallest, "component").withColumn("component_id", F.col("keep.doc_id"))
    own_set = F.struct(*_SET)
    several = members.filter("doc_id IS NOT NULL").groupBy("doc_id")
    several = several.agg(F.min(own_set).alias("low"), F.max(own_set).alias("high")).filter("low != high")
    several = stored(several.select("doc_id"), "jaccard-several")
    repeated_ids = not several.isEmpty()
    if repeated_ids:
        united = _with_component(classes, stored(_united(found, classes, named, several), "jaccard-united"))
        united = stored(united.select("class", "component", "first"), "jaccard-united")
        lowest = united.groupBy("component").agg(F.min("first").alias("component_id"))
        placed = placed.drop("component_id").join(united.join(lowest, "component").select("class", "component_id"), "class")
    placed = stored(placed.select(*_SET, "first", "component_id", "keep"), "jaccard-placed")
    rows = members.join(placed, same(members, placed, _SET), "left")
    known = members["doc_id"].isNotNull()
    alone = members["doc_id"]
    rows = rows.select(
        members["doc_id"],
        members["text_digest"],
        members["n"].alias("n_shingles"),
        F.when(known, F.coalesce(F.col("first"), alone)).alias("class_id"),
        F.when(known, F.coalesce(F.col("component_id"), alone)).alias("component_id"),
        F.when(known, F.struct(members["doc_id"], members["text_digest"]) == F.col("keep")).alias("kept"),
    ).withColumn("kept", F.coalesce("kept", F.lit(True)))
    if not repeated_ids:
        return rows
    # A text without words has the component of the others of its id.
    rows = stored(rows, "jaccard-rows")
    of_id = lookup_join(rows, several, ["doc_id"]).groupBy("doc_id").agg(F.min("component_id").alias("of_id"))
    joined = rows.join(stored(of_id, "jaccard-ids"), "doc_id", "left")
    return joined.withColumn("component_id", F.coalesce("of_id", "component_id")).drop("of_id")


def _active_sets(documents: DataFrame, classes: DataFrame, entries: DataFrame, words: int) -> DataFrame:
    """class, grams (the set) of the classes in entries, from the texts of their first documents."""
    active = classes.join(entries.select("class").distinct(), "class").select("first", "class", "s1", "s2")
    active = stored(active.withColumnRenamed("first", "doc_id"), "jaccard-active")
    schema = "class bigint, grams binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("class", "s1", "s2"))))
            for from_, to, sets in gram_sets(batch, words):
                # An id may have several texts.
                own = [(k[0], s.tobytes()) for k, s in zip(keys[from_:to], sets) if _signature(s)[1:] == k[1:]]
                yield _batch(list(zip(*own)) if own else [[], []], schema)

    texts = lookup_join(documents, active, ["doc_id"]).select("class", "s1", "s2", "text")
    rows = texts.mapInArrow(tidy(build), schema)
    return stored(rows.groupBy("class").agg(F.first("grams").alias("grams")), "jaccard-sets")
