"""The stages of the pipeline, and what the entry module does without this folder."""

import os
import re
import shutil
import subprocess
import sys

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from kerbside import workspace
from kerbside.llm import language, mixing
from kerbside.llm.common import stored
from tests_llm_data import HARD, LONG, SCHEMA

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shingles(text):
    words = text.encode().lower().split()  # of bytes: ASCII only
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(rows):
    """Of rows (id, text, …) those that stay: of each component of sets with 75 % in common, the least (id, text digest)."""
    sets = [shingles(r["text"] or "") for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            alike = sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j])
            if rows[i]["doc_id"] is not None and rows[j]["doc_id"] is not None and alike:
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for r, g, s in zip(rows, group, sets):
        if r["doc_id"] is not None and s:
            first[g] = min(first.get(g, r["doc_id"]), r["doc_id"])
    return [r for r, g, s in zip(rows, group, sets) if r["doc_id"] is None or not s or first[g] == r["doc_id"]]


def plain_run(spark, docs):
    """All stages by plain work on rows; languages, rates and draws are the operators'."""
    model = language.learn(docs.filter(language.learning_part(F.col("doc_id"))))
    rows = [r.asDict() for r in language.identify(docs, model).collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r["text"] or "") and r["fit"] > -1]
    groups = {}
    for r in rows:
        groups.setdefault("".join(re.split(r"[\x20\x09-\x0D]", r["text"])), []).append(r)
    rows = [min(g, key=lambda r: (-len(r["text"]), r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    rows = plain_near(rows)
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows], SCHEMA)
    pieces = []
    for r in mixing.mix(frame).collect():
        words = len(r["text"].encode().split())
        for start in range(0, max(1, words), 8192):
            pieces += [(r["doc_id"], start, min(8192, words - start))] * r["taken_times"]
    return sorted(pieces, key=repr)


def test_run_against_plain_work(spark, build, tmp_path):
    """Copies of each kind, junk, long texts, texts without letters and columns of other names."""
    base = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text and len(r.text) < 3000]
    rows = [(r.doc_id + 1000, r.text, r.lang, r.source) for r in base[:70]]
    rows += [(r.doc_id + 2000, " ".join(r.text.split()), r.lang, "copies") for r in base[:20]]
    rows += [(r.doc_id + 3000, r.text + " and one more word", r.lang, None) for r in base[20:40]]
    rows += [(500, "xqzv kjwq zzxq wvkx qqjz xkzw vqxj zkqv " * 30, None, "a")]
    rows += [row for row in HARD if row[0] is not None and row[0] != 5]
    for clash in (False, True):
        folder = tmp_path / f"sf{clash}"
        docs = build(rows, clash)
        docs.write.parquet(f"{folder}/documents.parquet")
        packed = pipeline.run(spark, str(folder))
        got = sorted(((r.doc_id, r.first_word, r.words) for r in packed.collect()), key=repr)
        assert got == plain_run(spark, docs)
        inside = packed.groupBy("bin_id").agg(F.sum("words").alias("n"), F.max("used").alias("used"), F.max("capacity").alias("c"))
        assert inside.filter("n != used OR used > c").count() == 0


def test_stages_of_hard_rows(spark, build):
    """Every stage returns documents; without labels nothing is rejected; no rows give none."""
    for rows, clash in ((HARD, False), (HARD, True), ([(i, t, None, s) for i, t, _, s in HARD], False), ([], False)):
        docs = build(rows, clash)
        for name, stage in pipeline.STAGES:
            before, docs = docs, stage(spark, docs, "")
            if name != "best_fit_packing":
                assert docs.columns == list(pipeline.COLUMNS)
                docs = stored(docs, "test-stage")
            if name == "language_id" and not any(lang for *_, lang, _ in rows):
                assert docs.count() == before.count()
        assert (docs.count() > 0) == (len(rows) > 0)


def test_a_stored_table_is_not_written_again(spark, build, tmp_path):
    frame = build([(1, "a b", "en", "s"), (2, "ab", "en", "s"), (3, "c", None, None)]).withColumn("n_chars", F.lit(1).cast("bigint"))
    frame.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    assert pipeline._stored_at(spark, docs).endswith("/docs")
    for other in (docs.filter("doc_id > 1"), docs.union(docs), docs.drop("lang"), frame):
        assert pipeline._stored_at(spark, other) is None
    assert sorted(r.doc_id for r in pipeline.drop_copies(spark, docs, "").collect()) == [1, 3]
    assert sorted(r.doc_id for r in pipeline.drop_copies(spark, docs.filter("doc_id > 1"), "").collect()) == [2, 3]


def test_run_leaves_its_result_only(spark):
    shared = os.path.dirname(workspace.scratch(spark, "probe"))
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert [name.rpartition("-")[0] for name in set(os.listdir(shared)) - before] == ["pipeline-last"]


def test_each_stage_drops_only_what_it_should(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = pipeline.keep_identified(spark, docs, "").select("doc_id")
    assert kept.count() == docs.count()
    junk = "xqzv kjwq zzxq wvkx qqjz xkzw vqxj zkqv " * 30
    odd = spark.createDataFrame([(5000, "12 34", None, None, 5), (5001, None, "en", None, 0), (5002, junk, None, None, 9)], docs.schema)
    assert pipeline.keep_identified(spark, docs.union(odd), "").filter("doc_id >= 5000").count() == 0
    single = pipeline.drop_copies(spark, docs, "")
    assert single.count() == len({"".join(re.split(r"[\x20\x09-\x0D]", r["text"])) for r in docs.collect()})


def test_mixture_of_three_languages_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    longest = docs.filter("lang IS NOT NULL").groupBy("lang").agg(F.max_by("text", "n_chars"))
    texts = [r[1] for r in longest.orderBy("lang").limit(3).collect()]
    mixture = " ".join(t[:n] for t, n in zip(texts, (1350, 900, 750)))
    odd = spark.createDataFrame([(5000, mixture, None, None, len(mixture))], docs.schema)
    model = language.learn(docs.filter(language.learning_part(F.col("doc_id"))))
    assert language.identify(odd, model).first()["score"] < 0.5
    assert pipeline.keep_identified(spark, docs.union(odd), "").filter("doc_id = 5000").count() == 1


def test_near_copies_leave_one(spark, build):
    near = LONG.replace("w3x3 ", "other ", 1)
    rows = [(7, LONG, None, None), (3, near, None, None), (9, "quite another text of some words", None, None), (None, near, None, None)]
    left = pipeline.drop_near_copies(spark, build(rows), "")
    assert sorted((r[0] for r in left.collect()), key=repr) == [3, 9, None]


def test_near_copies_by_text_where_an_id_has_several(spark, build):
    """Id 5 has a near copy of 3 and another text; id 1 two near copies, equal sets and a repeated row."""
    near, other, small = LONG.replace("w3x3 ", "other ", 1), "quite another text of some words", "One two three four five six"
    texts = [(3, LONG), (5, near), (5, other), (1, small), (1, small.lower()), (1, small), (2, small.upper())]
    left = pipeline.drop_near_copies(spark, build([(i, t, None, None) for i, t in texts]), "")
    kept = sorted((r["doc_id"], r["text"]) for r in left.collect())
    assert kept in [sorted([(3, LONG), (5, other), (1, t)]) for t in (small, small.lower())]


def test_entry_without_these_operators(tmp_path):
    for name in ("kerbside", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / name)
    os.rename(tmp_path / "kerbside" / "llm", tmp_path / "elsewhere")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'zone_hourly' in q and not any(n[:2] == 'op' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": os.environ["PATH"]})
