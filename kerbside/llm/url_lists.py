"""Captures against dated URL lists (native: DataFrame operations only).

Dated entries (add or remove a key) become intervals in which a key is listed. An as-of
join then evaluates every capture against what was listed when it was fetched. A key is a
host or a domain above it, alone or with the first parts of the path, of any number.

Defined cases: of entries for one key on one date an addition counts. An entry without
list, key or date is void; one without action is an addition. A capture whose url is null
or has no host matches nothing, nor does one without time. Case counts in paths, not in hosts;
slashes at the end of an entry's key do not count. Hosts of any length have all domains
above them, as far as an entry can match. Repeated captures are each kept. Empty lists
block nothing; no captures give no rows. Extra columns are carried along; of columns that
bear the name of one computed here, the computed one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import same, stored

ADDED = ("blocked", "matches")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]+)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def entry_key(key: Column) -> Column:
    """The key of an entry as ``url_keys`` writes it."""
    name = F.substring_index(key, "/", 1)
    return F.concat(F.lower(name), F.rtrim(F.substr(key, F.length(name) + 1), F.lit("/")))


def key_depth(key: Column) -> Column:
    """How many parts of a path a key has."""
    return F.size(F.split(key, "/")) - 1


def key_labels(key: Column) -> Column:
    """How many labels the name of a key has."""
    return F.size(F.split(F.substring_index(key, "/", 1), r"\."))


def url_keys(url: Column, depth: int | None = None, labels_: int | None = None) -> Column:
    """The host and its domains, each alone and with every beginning of the path.

    Beginnings end with a part; those of more than ``depth`` parts are left out, and so are
    names of more than ``labels_`` labels. Hosts may be of any length.
    """
    name = host(url)
    labels = F.split(name, r"\.")
    n = F.size(labels)
    first = F.lit(1) if labels_ is None else F.greatest(F.lit(1), n - F.lit(labels_) + 1)
    names = F.transform(F.sequence(first, n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    parts = F.split(F.regexp_extract(url, _PATH, 1), "/")
    most = F.size(parts) if depth is None else F.least(F.size(parts), F.lit(depth))
    ends = F.filter(F.sequence(F.lit(0), most), lambda i: (i == 0) | (F.get(parts, i - 1) != ""))
    below = F.transform(ends, lambda i: F.when(i == 0, "").otherwise(F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    keys = F.flatten(F.transform(names, lambda x: F.transform(below, lambda y: F.concat(x, y))))
    return F.when(name != "", keys)


def intervals(entries: DataFrame) -> DataFrame:
    """list, key, valid_from, valid_until (null: still listed) of (list, key, action, dated).

    Entries are first reduced to one per key and date, so that a key has as many rows as
    there are dates at most.
    """
    known = entries.filter("list IS NOT NULL AND key IS NOT NULL AND dated IS NOT NULL")
    added = F.coalesce(F.col("action") != "remove", F.lit(True))
    daily = known.groupBy("list", entry_key(F.col("key")).alias("key"), F.to_date("dated").alias("valid_from"))
    daily = daily.agg(F.max(added).alias("listed"))
    until = F.lead("valid_from").over(Window.partitionBy("list", "key").orderBy("valid_from"))
    return daily.withColumn("valid_until", until).filter("listed").drop("listed")


def judge(captures: DataFrame, entries: DataFrame, blocking: str = "block", allowing: str = "allow") -> DataFrame:
    """The captures (url, fetched_at, …) with blocked and matches.

    ``matches`` names the entries active at fetch time, as sorted ``list:key`` joined by
    spaces. A capture is blocked if an entry of ``blocking`` matches and none of ``allowing``.
    """
    active = stored(intervals(entries), "url-intervals")
    captures = captures.drop(*ADDED)
    fetches = captures.select("url", "fetched_at").distinct()
    # Names and beginnings of paths with more parts than any entry has could match nothing.
    depth, most = active.agg(F.max(key_depth(F.col("key"))), F.max(key_labels(F.col("key")))).first()
    keyed = fetches.withColumn("key", F.explode(F.array_distinct(url_keys(F.col("url"), depth or 0, most or 1))))
    day = F.to_date("fetched_at")
    listed = keyed.join(active, "key").filter(
        (F.col("valid_from") <= day) & (F.col("valid_until").isNull() | (day < F.col("valid_until")))
    )
    found = listed.groupBy("url", "fetched_at").agg(
        F.array_join(F.sort_array(F.collect_set(F.concat_ws(":", "list", "key"))), " ").alias("matches"),
        (F.max(F.col("list") == blocking) & ~F.max(F.col("list") == allowing)).alias("blocked"),
    )
    found = stored(found, "url-matches")
    joined = captures.join(found, same(captures, found, ["url", "fetched_at"]), "left")
    return joined.select(
        *[captures[c] for c in captures.columns],
        F.coalesce("blocked", F.lit(False)).alias("blocked"),
        F.coalesce("matches", F.lit("")).alias("matches"),
    )
