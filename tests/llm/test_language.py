"""Language mixtures: accuracy on held-out documents, mixtures found, odd texts."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import language
from tests_llm_data import HARD, LONG

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    return language.learn(documents.filter(language.learning_part(F.col("doc_id"))))


def test_held_out_accuracy(spark, model):
    documents = spark.read.parquet(f"{SF}/documents.parquet").filter(language.held_out(F.col("doc_id")))
    found = language.identify(documents, model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


@pytest.mark.parametrize("clash", [False, True])
def test_hard_rows(build, model, clash):
    found = language.identify(build(HARD, clash), model).collect()
    assert len(found) == len(HARD)
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == letters
        assert r["score"] == pytest.approx(sum(x["share"] for x in r["languages"][:1]))
    assert sum(x["share"] for x in found[0]["languages"]) in (0, pytest.approx(1))


def test_nothing_learned(build):
    model = language.learn(build([(1, "some words", None, None)]))
    found = language.identify(build([(1, "some words", None, None)]), model).first()
    assert (found["lang_pred"], found["score"], found["languages"]) == ("und", 0.0, [])
    assert language.identify(build([]), model).count() == 0


def test_a_filter_predicts_once(build, model):
    """The prediction is the costly part: filters on its result do not repeat it."""
    found = language.identify(build(HARD), model).filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("fit") > -1.0))
    plan = found.select("doc_id", "lang_pred")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan)) == 1
    assert found.count() > 0


def test_mixture_of_two(spark, model, build):
    """A text of two parts English and one part German."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars between 2000 and 9000")
    en, de = (documents.filter(f"lang = '{x}'").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    found = language.identify(build([(1, f"{en[:2000]} {de[:1000]}", None, None)]), model).first()
    shares = {x["lang"]: x["share"] for x in found["languages"]}
    assert found["lang_pred"] == "en" and set(shares) == {"en", "de"}
    assert shares["de"] == pytest.approx(1 / 3, abs=0.08)


def test_counts_of_pieces_add_up(monkeypatch):
    texts = [LONG, "é ß", None, "", "one two"] * 3
    whole = np.concatenate([c for _, c in language.trigrams(texts)])
    monkeypatch.setattr(language, "_PIECE", 1000)
    monkeypatch.setattr(language, "_CHARS_AT_ONCE", 5000)
    monkeypatch.setattr(language, "_DOCUMENTS_AT_ONCE", 2)
    blocks = list(language.trigrams(texts))
    assert (np.concatenate([c for _, c in blocks]) == whole).all()
    assert [i for rows, _ in blocks for i in rows] == list(range(15))


def test_em_against_a_plain_loop():
    r = np.random.default_rng(1)
    likelihood = r.dirichlet(np.ones(50), 3).T
    counts = r.integers(0, 5, (4, 50))
    share = np.full((4, 3), 1 / 3)
    for _ in range(15):
        for i in range(4):
            parts = share[i] * likelihood
            parts *= (counts[i] / parts.sum(axis=1))[:, None]
            share[i] = parts.sum(axis=0) / counts[i].sum()
    assert language.shares(counts, likelihood, penalty=-10) == pytest.approx(share, abs=0.05)
    assert (language.shares(counts, likelihood, penalty=10).max(axis=1) == 1).all()
