"""Mix sources to target weights by repeating documents.

Words per source are summed, targets follow from weights and a limit on repetition, and
each document is taken floor(rate) times and once more by a Bernoulli draw seeded by a hash
of the document, with the probability of the remaining fraction. The draws of a source are
made with several seeds at once, in one aggregate, and those nearest to its target count.

Defined cases: a null text has no words; a null source is a source of its own, last in
order. A source without words gets target 0 and is not taken. Rows with equal id and text
draw alike. No rows give no rows. Extra columns are carried along; of columns that bear
the name of one computed here, the computed one stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import SPACE_CLASS, numbered, stored, text_of
from kerbside.operators.joins import lookup_join

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = 8
SEEDS = 32
ADDED = ("size", "source_size", "target", "rate", "taken_times")


def word_count(text: Column) -> Column:
    """Number of words: places where one begins."""
    return F.regexp_count(F.concat(F.lit(" "), text), F.lit(rf"{SPACE_CLASS}[^\x20\x09-\x0D]")).cast("bigint")


def _weighted(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources in the order of their names, weighed in turn.

    Positions come from a range partition and one count per partition, so that any
    number of sources is fine.
    """
    ordered = sizes.withColumn("no_name", F.col("source").isNull()).repartitionByRange("no_name", "source")
    ranked = numbered(ordered.sortWithinPartitions("no_name", "source"), "place", "mix-sources")
    turn = (F.col("place") % len(weights)).cast("int")
    return ranked.select("source", "source_size", F.array(*map(F.lit, map(float, weights)))[turn].alias("weight"))


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, target. Sources at ``most`` times their size give the rest to the others.

    One number is sought: the words per unit of weight. Each round is one aggregate; at
    least one more source reaches its limit in it, and usually all that will.
    """
    sources = stored(_weighted(sizes, weights), "mix-weighted")
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while whole:
        limit = F.col("source_size") * most
        capped = F.col("weight") * level >= limit
        now = sources.agg(
            F.count_if(capped), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if now[0] == full or not now[2]:
            break
        full, level = now[0], (share * whole - (now[1] or 0.0)) / now[2]
    target = F.least(F.col("weight") * level, F.col("source_size") * most)
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """Each document once, with size, source_size, target and rate of its source, and taken_times."""
    sized = documents.drop(*ADDED, "_mix", "_seed").withColumn("size", word_count(text_of()))
    # Texts are gone over twice; what the choice of seeds needs of them is small.
    narrow = stored(sized.select(_named(), "source", "size", _hash().alias("hash")), "mix-rows")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(stored(sizes, "mix-sizes"), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = stored(wanted.select(_named(), "source_size", "target", rate.alias("rate")), "mix-targets")
    wanted = stored(wanted.join(_seeds(narrow, wanted, seed), "_mix"), "mix-seeds")
    joined = lookup_join(sized.withColumn("_mix", _named()), wanted, ["_mix"], "left").drop("_mix")
    times = F.floor("rate") + _drawn(_hash(), F.col("_seed")).cast("bigint")
    return joined.withColumn("taken_times", times).drop("_seed")


def _named() -> Column:
    """A source as a key that is never null."""
    return F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("_mix")


def _hash() -> Column:
    return F.xxhash64("doc_id", text_of())


def _drawn(hashed: Column, seed: Column) -> Column:
    """Whether a document is taken once more than the whole part of its rate."""
    draw = F.pmod(F.xxhash64(seed, hashed), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return draw < F.col("rate") - F.floor("rate")


def _seeds(narrow: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """Per source that seed, of ``SEEDS`` from the given one on, whose draws come nearest to the target."""
    numbers = [seed + i for i in range(SEEDS)]
    rows = lookup_join(narrow.select("_mix", "size", "hash"), wanted, ["_mix"])
    drawn = [F.sum(F.when(_drawn(F.col("hash"), F.lit(n)), F.col("size")).otherwise(0)) for n in numbers]
    totals = rows.groupBy("_mix").agg(
        F.first("target").alias("target"), (F.floor(F.first("rate")) * F.sum("size")).alias("whole"), F.array(*drawn).alias("drawn")
    )
    missed = F.transform("drawn", lambda x, i: F.struct(F.abs(F.col("whole") + x - F.col("target")).alias("by"), i.alias("i")))
    return totals.select("_mix", (F.array_min(missed)["i"] + seed).alias("_seed"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken, numbered by ``copy`` from 1."""
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("taken_times"))
    taken = mixed.filter(F.col("taken_times") > 0).drop("copy").withColumn("copy", F.explode(copies))
    return taken.drop(*ADDED)
