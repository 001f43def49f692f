"""From raw documents to packed training sequences, in stages.

Each stage reads what the one before kept. All but the last return documents. A stage leaves
the small tables that its result looks up in the scratch folder; ``run`` removes them.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import exact_dedup, jaccard, language, mixing, packing
from kerbside.llm.common import fill, table
from kerbside.operators.joins import lookup_join
from kerbside.workspace import remove, scratch, settled, temporary

# A text whose trigrams are, on average, less than 1/e times as likely in its languages as by
# chance is in none of them. A model of few trigrams is too even to reject anything so.
LEAST_FIT = -1.0
COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages, however many; the model learns from those not held out.

    What has no letters goes, and what is much less likely in any mixture of the languages than
    by chance. A document without a language gets the leading one. If nothing could be
    learned, all documents stay as they are.
    """
    docs = fill(docs, COLUMNS)
    model = language.learn(docs.filter(language.learning_part(F.col("doc_id"))))
    if not model.labels:
        return docs
    found = language.identify(docs, model)
    found = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("fit") > LEAST_FIT))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact duplicates go; the row that stays is the operator's."""
    path = _stored_at(spark, docs)
    if path is None:
        path = scratch(spark, "pipeline-copies")
        fill(docs, COLUMNS).write.parquet(path)
    return exact_dedup.dedupe(spark, path, columns=list(COLUMNS)).filter("kept").select(*COLUMNS)


def _stored_at(spark: SparkSession, docs: DataFrame) -> str | None:
    """Where the documents lie, if they are a stored table as it is, with its columns; else None."""
    if any(dict(docs.dtypes).get(name) != kind for name, kind in COLUMNS.items()):
        return None
    files = docs.inputFiles()
    if not files:
        return None
    for path in (files[0], files[0].rpartition("/")[0]):
        # A table is the same under the name it was read by: with its file system or without.
        for name in (path, urlsplit(path).path, f"file:{urlsplit(path).path}"):
            try:
                again = spark.read.schema(docs.schema).parquet(name)
            except AnalysisException:  # no such path in that file system
                continue
            if docs.sameSemantics(again):
                return path
    return None


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row stays, of the smallest id.

    Texts that share an id are told apart. A document without id is in no component and stays.
    Rows are marked by their keys; texts are not shuffled unless the marks outgrow a broadcast.
    """
    key = ["doc_id", "text_digest"]
    docs = fill(docs, COLUMNS)

    def marks() -> DataFrame:
        joined = jaccard.join(docs).filter("doc_id IS NOT NULL").groupBy(*key)
        joined = joined.agg(
            F.bool_and("kept").alias("stays"), ((F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)).alias("repeated")
        )
        return joined.filter("NOT stays OR repeated")

    marked = settled(spark, "pipeline-near-copies", marks)
    rows = lookup_join(docs.withColumn("text_digest", jaccard.text_digest()), marked, key, "left")
    left = rows.filter("stays IS NULL")
    if not marked.filter("stays").isEmpty():  # rows that repeat an id and text: one of them
        left = left.unionByName(rows.filter("stays").dropDuplicates(key))
    return left.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources meet their target weights."""
    return mixing.emit(mixing.mix(fill(docs, COLUMNS))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of all documents lie in sequences of permitted lengths."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Language identification and the draws of the mix are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What the stages wrote on their way is removed, after an error too."""
    docs, before = table(spark, sf_dir, "documents"), None
    last = scratch(spark, "pipeline-last")
    with temporary(spark):
        for number, (name, stage) in enumerate(STAGES, 1):
            path = last if number == len(STAGES) else scratch(spark, f"pipeline-{name}")
            with temporary(spark):
                stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if before is not None:
                remove(spark, before)
            before = path
    return docs
