"""The operators of this folder as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    exact_dedup,
    jaccard,
    language,
    lexical,
    licenses,
    line_dedup,
    mixing,
    packing,
    periods,
    sharding,
    topk,
    url_lists,
    warc,
)
from kerbside.llm.common import table, text_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_warc_index(spark, sf):
    """All pages through archives and the merged capture index."""
    history = warc.archive_history(table(spark, sf, "pages"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at"
    )


@query
def op2_jaccard_join(spark, sf):
    """All documents with the component of near duplicates they belong to."""
    return jaccard.join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_maxscore_topk(spark, sf):
    """The ten best of all embeddings for each hundredth."""
    return topk.nearest(table(spark, sf, "embeddings"))


@query
def op4_histogram_sharding(spark, sf):
    """All documents in 16 shards of near equal bytes."""
    return sharding.shard(table(spark, sf, "documents")).select(
        "doc_id",
        "size",
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_language_mixture(spark, sf):
    """All documents with their language, by a model of those not held out."""
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = language.learn(documents.filter(language.learning_part(F.col("doc_id"))))
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages"
    )


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for hosts and domains of the pages, and the first parts of paths below
    them (with the name in capitals), chosen by digits of a hash.

    About a third of the keys are listed from a day in 2024 on; half of those are taken
    off later, and some of them come back.
    """
    name = url_lists.host(F.col("url"))
    domain = F.regexp_replace(name, r"^[^.]+\.", "")
    part = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    below = F.when(part != "", F.concat(F.upper(domain), F.lit("/"), part)).otherwise("")
    names = pages.select(F.explode(F.array(name, domain, below)).alias("key")).filter("key != ''").distinct()
    digit = lambda i: F.conv(F.substring(F.md5("key"), i, 2), 16, 10).cast("int")
    listed = names.filter(digit(1) % 3 == 0).withColumns({"since": digit(3), "days": digit(5) + 1, "turn": digit(7)})
    list_ = F.when(F.col("turn") % 5 == 0, "allow").otherwise("block").alias("list")
    step = F.explode(F.sequence(F.lit(0), F.col("turn") % 3)).alias("step")
    steps = listed.select("key", list_, "since", "days", step)
    dated = F.date_add(F.lit("2024-01-01").cast("date"), F.col("since") + F.col("step") * F.col("days"))
    return steps.select("list", "key", F.when(F.col("step") == 1, "remove").otherwise("add").alias("action"), dated.alias("dated"))


@query
def op6_temporal_url_lists(spark, sf):
    """All pages, fetched one every ten minutes from 2024 on, against lists of their hosts and domains."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    fetched = F.timestamp_seconds(F.lit(warc.FIRST_CAPTURE) + F.col("page_id") * 600)
    judged = url_lists.judge(pages.withColumn("fetched_at", fetched), list_entries(pages))
    return judged.select("page_id", "url", "blocked", "matches")


@query
def op7_best_fit_packing(spark, sf):
    """All documents in sequences of 512 to 8,192 words."""
    return packing.pack(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op8_mix_sources(spark, sf):
    """All documents, mixed by source."""
    mixed = mixing.mix(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("taken_times")).alias("taken")
    )


@query
def op9_exact_dedup(spark, sf):
    """All documents with the row that stays of equal texts."""
    return exact_dedup.dedupe(spark, f"{sf}/documents.parquet")


@query
def op10_line_dedup(spark, sf):
    """All documents after lines that many share are dropped."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    bitmaps = line_dedup.stored_bitmaps(documents)
    kept = line_dedup.apply_bitmaps(documents, bitmaps)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op11_license_rules(spark, sf):
    """All documents with the license phrases and detections of the ordered rules."""
    found = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))
    starts = F.transform("base", lambda d: d["first"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        licenses.labels_of(F.col("base")).alias("base_labels"),
        licenses.labels_of(F.col("base"), F.col("detections")).alias("labels"),
        licenses.score_of(F.col("detections")).alias("score"),
    )


@query
def op12_block_max_search(spark, sf):
    """The twenty best of all documents for each benchmark item."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return lexical.search(documents, table(spark, sf, "benchmark"))


@query
def op13_periodic_runs(spark, sf):
    """All documents with their runs of four periods and more, some texts made periodic first."""
    found = periods.find(table(spark, sf, "documents").select("doc_id", "text"), rewrite=periods.planted)
    best = periods.longest(F.col("runs"))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(periods.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
