"""Languages of a text as a mixture, fitted by expectation maximisation.

The model holds, for each label, the likelihood of hashed letter trigrams, counted over
all labelled texts. For each text EM estimates the share of every language; then sets of
the leading languages are compared by penalised likelihood, and the shares in the best
set are the result. Only the text is looked at.

Defined cases: a text that is null or has no letter gets ``und``, score 0 and no
languages, as does every text if nothing could be learned. Of equal shares the language
first in code point order leads. Repeated rows get equal results; no rows give no rows.
Texts are read whole, long ones in pieces whose counts add up. Extra columns are carried
along; of columns that bear the name of one computed here, the computed one stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches

UNKNOWN = "und"
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
STEPS = 15
# What a language has to add to the log-likelihood: so much for each trigram of the text,
# and half the logarithm of their number. A language of less than about a hundredth of a
# text, however long, is not listed.
PENALTY = 0.02
ADDED = ("lang_pred", "score", "languages", "fit")
_PIECE = 1 << 18
_DOCUMENTS_AT_ONCE = 100
_CHARS_AT_ONCE = 1 << 19
_RESULT = "lang_pred string, score double, languages array<struct<lang: string, share: double>>, fit double"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded length, cut at spaces if there are any."""
    start = 0
    while len(text) - start > _PIECE:
        end = text.rfind(" ", start, start + _PIECE) + 1
        end = end if end > start else start + _PIECE
        yield text[start:end]
        start = end
    yield text[start:]


def _count(pieces: list[str], owners: list[int], n: int) -> np.ndarray:
    """Trigram counts as an n x BUCKETS array; the middle of a trigram is a letter."""
    lowered = [piece.lower() for piece in pieces]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint32)
    owner = np.repeat(np.array(owners, dtype=np.int64), [len(piece) + 1 for piece in lowered])
    left, mid, right = codes[:-2], codes[1:-1], codes[2:]
    hashed = (left * np.uint32(0x9E3779B1)) ^ (mid * np.uint32(0x85EBCA6B)) ^ (right * np.uint32(0xC2B2AE35))
    hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    keys = owner[: len(mid)] * BUCKETS + (hashed >> np.uint32(32 - BUCKET_BITS))
    return np.bincount(keys[mid != 0], minlength=n * BUCKETS).reshape(n, BUCKETS)


def trigrams(texts: list[str | None]) -> Iterator[tuple[range, np.ndarray]]:
    """Counts of the texts, in blocks of bounded size."""
    start, pieces, owners, chars, counts = 0, [], [], 0, None
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            pieces.append(piece)
            owners.append(i - start)
            chars += len(piece)
            if chars >= _CHARS_AT_ONCE:  # also within a long text
                part = _count(pieces, owners, i - start + 1)
                if counts is not None:
                    part[: len(counts)] += counts
                counts, pieces, owners, chars = part, [], [], 0
        if i - start + 1 == _DOCUMENTS_AT_ONCE or i + 1 == len(texts) or (counts is not None and not pieces):
            n = i - start + 1
            part = _count(pieces, owners, n) if pieces else np.zeros((n, BUCKETS), dtype=np.int64)
            if counts is not None:
                part[: len(counts)] += counts
            yield range(start, i + 1), part
            start, pieces, owners, chars, counts = i + 1, [], [], 0, None


@dataclass(frozen=True)
class LanguageModel:
    """labels, and the likelihood of each bucket (rows) under each of them (columns)."""

    labels: list[str]
    likelihood: np.ndarray


def learn(documents: DataFrame, label: str = "lang") -> LanguageModel:
    """Count the trigrams of all labelled texts. The driver gets one row per label and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column("label").to_pylist(), dtype=object)
            for rows, counts in trigrams(batch.column("text").to_pylist()):
                own = labels[rows.start : rows.stop]
                for name in set(own):
                    sums[name] = sums.get(name, 0) + counts[own == name].sum(axis=0)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["label", "bucket", "n"]
            )

    small_batches(documents.sparkSession)
    rows = documents.select(F.col(label).alias("label"), "text").filter("label IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(count, "label string, bucket bigint, n bigint").groupBy("label", "bucket")
    found = counts.agg(F.sum("n").alias("n")).toArrow()
    labels = sorted(set(found.column("label").to_pylist()))
    table = np.full((BUCKETS, len(labels)), SMOOTHING)
    place = {name: i for i, name in enumerate(labels)}
    columns = np.array([place[x] for x in found.column("label").to_pylist()], dtype=np.int64)
    table[found.column("bucket").to_numpy(), columns] += found.column("n").to_numpy()
    return LanguageModel(labels, table / table.sum(axis=0) if labels else table)


def _fit(likelihood: np.ndarray, counts: np.ndarray, starts: np.ndarray, share: np.ndarray, steps: int):
    """EM on the trigrams of several texts at once: shares and log-likelihood of each.

    ``likelihood`` has a row and ``counts`` a number for each distinct trigram of a text;
    ``starts`` says where the rows of each text begin.
    """
    lengths = np.diff(np.append(starts, len(counts)))
    total = np.add.reduceat(counts, starts)[:, None]
    for _ in range(steps):
        parts = np.repeat(share, lengths, axis=0) * likelihood
        parts *= (counts / parts.sum(axis=1))[:, None]
        share = np.add.reduceat(parts, starts, axis=0) / total
    mixed = (np.repeat(share, lengths, axis=0) * likelihood).sum(axis=1)
    return share, np.add.reduceat(counts * np.log(mixed), starts)


def shares(counts: np.ndarray, likelihood: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Language shares of each text (rows of ``counts``, none of them without trigrams)."""
    n, languages = len(counts), likelihood.shape[1]
    text, bucket = np.nonzero(counts)
    numbers = counts[text, bucket].astype(np.float64)
    rows = likelihood[bucket]
    starts = np.searchsorted(text, np.arange(n))
    size = counts.sum(axis=1)
    alone = np.add.reduceat(numbers[:, None] * np.log(rows), starts, axis=0)
    best = np.eye(languages)[alone.argmax(axis=1)]
    cost = penalty * size + 0.5 * np.log(size)
    value = alone.max(axis=1) - cost
    if languages == 1:
        return best
    full, bound = _fit(rows, numbers, starts, np.full((n, languages), 1 / languages), steps)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    for k in range(2, languages + 1):
        # No set can be more likely than all languages together.
        open_ = np.flatnonzero(bound - k * cost > value)
        if not len(open_):
            break
        member = np.isin(text, open_)
        at = np.searchsorted(text[member], open_)
        share = np.where(rank[open_] < k, np.maximum(full[open_], 1e-9), 0)
        share, likely = _fit(rows[member], numbers[member], at, share / share.sum(axis=1, keepdims=True), steps)
        better = likely - k * cost[open_] > value[open_]
        best[open_[better]] = share[better]
        value[open_[better]] = (likely - k * cost[open_])[better]
    return best


def against_chance(counts: np.ndarray, likelihood: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text under its mixture, per trigram, above that under equally likely buckets."""
    text, bucket = np.nonzero(counts)
    mixed = (likelihood[bucket] * share[text]).sum(axis=1)
    gained = np.bincount(text, counts[text, bucket] * np.log(mixed * BUCKETS), minlength=len(counts))
    return gained / counts.sum(axis=1)


def predictor(model: LanguageModel, penalty: float = PENALTY):
    """A function of a text column: struct of lang_pred, score, languages and fit."""
    labels, likelihood = model.labels, model.likelihood

    @F.pandas_udf(_RESULT)
    def predict(texts: pd.Series) -> pd.DataFrame:
        out: list[tuple] = [(UNKNOWN, 0.0, [], None)] * len(texts)
        for rows, counts in trigrams(texts.tolist()) if labels else ():
            some = np.flatnonzero(counts.any(axis=1))
            if not len(some):
                continue
            found_shares = shares(counts[some], likelihood, penalty=penalty)
            fits = against_chance(counts[some], likelihood, found_shares).tolist()
            for i, share, fit in zip(some, found_shares, fits):
                order = [j for j in np.argsort(-share, kind="stable") if share[j] > 0]
                found = [{"lang": labels[j], "share": float(share[j])} for j in order]
                out[rows.start + i] = (found[0]["lang"], min(1.0, found[0]["share"]), found, fit)
        return pd.DataFrame(out, columns=list(ADDED))

    return predict


def identify(documents: DataFrame, model: LanguageModel, penalty: float = PENALTY) -> DataFrame:
    """The documents with lang_pred, score (share of that language), languages (all of the set) and
    fit (by how much a trigram is more likely under them than by chance, as a logarithm; null for ``und``).

    A filter on these columns is not pushed below the prediction, which would then run twice.
    """
    small_batches(documents.sparkSession)
    found = predictor(model, penalty).asNondeterministic()("text")
    rows = documents.drop(*ADDED, "_found").withColumn("_found", found)
    return rows.select("*", "_found.*").drop("_found")


def learning_part(doc_id: Column) -> Column:
    """Two thirds of the documents, by a hash of the id: those a model may learn from."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


