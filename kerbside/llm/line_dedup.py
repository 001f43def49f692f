"""Lines that many documents share, as compressed keep bitmaps (native).

Lines become hashes of their keys. Per key, partial counts meet in a range partition by
hash with the largest document first, so that the line that stays is the first one read.
What is returned per document is the bitmap of kept lines as runs (first line, number of
lines); texts do not travel with it.

Defined cases: a null or empty text is one empty line. Rows with equal id and text get
the same bitmap, and each counts as a document of its own. A null id is smaller than any
other; if all holders of a line have none, all keep it. No rows give no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kerbside.llm.common import SPACES, UPPER, same, stored, text_of

MIN_CHARS = 20
MIN_DOCUMENTS = 3
SALTS = 32
_KEY = ["h1", "h2"]
_ROW = ["doc_id", "tag"]


def _lines() -> Column:
    return F.split(text_of(), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped, with A to Z in lower case. ``lower`` does that to ASCII; it is faster."""
    bare = F.btrim(line, F.lit(SPACES))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.xxhash64(text_of()).alias("tag"), _lines().alias("lines"))


def _hashed(line: Column, min_chars: int) -> Column:
    """128 bits of a line's key; null if the key is too short."""
    key = line_key(line)
    hashes = F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return F.when(F.char_length(key) >= min_chars, hashes)


def shared_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Keys of lines in at least ``min_documents`` documents, with the document that keeps them."""
    keys = F.array_distinct(F.array_compact(F.transform("lines", lambda x: _hashed(x, min_chars))))
    once = _rows(documents).select("doc_id", F.explode(keys).alias("key"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    parts = once.groupBy("key.h1", "key.h2", salt.alias("salt"))
    parts = parts.agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("doc_id"))
    ordered = parts.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, F.desc_nulls_last("doc_id"))
    found = ordered.groupBy(*_KEY).agg(F.sum("documents").alias("documents"), F.first("doc_id").alias("keeper"))
    return found.filter(F.col("documents") >= min_documents)


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, tag (hash of the text), n_lines, n_dropped, keep_runs, of documents that lose lines."""
    shared = stored(shared_lines(documents, min_chars, min_documents), "shared-lines")
    lines = _rows(documents).select(*_ROW, F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    hashed = lines.select(*_ROW, "n_lines", "pos", _hashed(F.col("line"), min_chars).alias("key"))
    lost = (
        hashed.filter("key IS NOT NULL")
        .select(*_ROW, "n_lines", "pos", "key.h1", "key.h2")
        .join(shared, _KEY)
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .select(*_ROW, "n_lines", "pos")
        .distinct()
    )
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*_ROW).orderBy("pos"))
    runs = lost.withColumn("island", island).groupBy(*_ROW, "n_lines", "island")
    runs = runs.agg(F.min("pos").alias("first"), F.count(F.lit(1)).cast("int").alias("lines"))
    gaps = runs.groupBy(*_ROW, "n_lines").agg(
        F.sum("lines").alias("n_dropped"), F.sort_array(F.collect_list(F.struct("first", "lines"))).alias("gaps")
    )
    return gaps.select(*_ROW, "n_lines", "n_dropped", _kept_between(F.col("gaps"), F.col("n_lines")).alias("keep_runs"))


def stored_bitmaps(documents: DataFrame, **limits: int) -> DataFrame:
    """The bitmaps as a written table: what the operator gives in place of texts."""
    return stored(keep_bitmaps(documents, **limits), "keep-bitmaps")


def _kept_between(gaps: Column, n_lines: Column) -> Column:
    """Runs of kept lines before, between and after the dropped ones."""
    n = F.size(gaps)

    def run(j: Column) -> Column:
        before = F.try_element_at(gaps, j)
        after = F.try_element_at(gaps, j + 1)
        first = F.coalesce(before["first"] + before["lines"], F.lit(0))
        return F.struct(first.alias("first"), (F.coalesce(after["first"], n_lines) - first).alias("lines"))

    from_first = F.when(gaps[0]["first"] > 0, F.array(F.struct(F.lit(0).alias("first"), gaps[0]["first"].alias("lines"))))
    later = F.transform(F.sequence(F.lit(1), n), run)
    every = F.concat(F.coalesce(from_first, F.array().cast("array<struct<first:int,lines:int>>")), later)
    return F.filter(every, lambda r: r["lines"] > 0)


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text without its dropped lines, n_lines, n_dropped."""
    rows = documents.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("tag"))
    joined = rows.join(bitmaps, same(rows, bitmaps, _ROW), "left")
    lines = F.split(rows["text"], "\n", -1)
    kept = F.flatten(F.transform("keep_runs", lambda r: F.slice(lines, r["first"] + 1, r["lines"])))
    return joined.select(
        rows["doc_id"],
        F.when(F.col("keep_runs").isNull(), rows["text"]).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.col("n_lines"), F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
    )
