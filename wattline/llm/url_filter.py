"""URL filtering by dated lists: every capture against the entries that were active when it was fetched.

A list is a log of changes: entry, added or removed, time. Each change opens a validity interval that
the entry's next change closes. An entry is a host (which covers its subdomains) or a host with
a path prefix that ends at a path segment. A capture has a few keys that could be entries: its
host and the host's parents, and its host with each beginning of its path, however long they are, but only
those of a depth (labels of a host, segments of a path) that the list has; one equality join on the key with a range
condition on the time is the as-of join. Intervals of one entry don't overlap, so a key matches at most
once, and the join returns no more rows than keys are listed. A hot host is split by the skew join, and
captures that match nothing are not joined again: matches are counted by capture before the shuffle.

Hosts are compared in lower case, without port, user and a final dot; a scheme is optional. An interval includes
its begin and excludes its end. Of changes of one entry at one time, a removal counts last.

Defined results: a capture without URL or time is matched by nothing and not blocked; changes without
entry, time or action are ignored; repeated changes change nothing; captures with equal id, URL and
time are one row of verdicts, and ``rows`` tells how many they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import fresh


def host_of(url: Column) -> Column:
    """The host of a URL, empty if there is none."""
    rest = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://|^//", "")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$|\.+$", "")


def path_of(url: Column) -> Column:
    """The path of a URL, without query and fragment, from its first slash."""
    rest = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://|^//", "")
    return F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def entry_key(entry: Column) -> Column:
    """An entry as captures' keys spell it: the host, then the path without its last slash."""
    return F.concat(host_of(entry), F.regexp_replace(path_of(entry), r"/+$", ""))


def depth_of(key: Column) -> Column:
    """The depth of an entry: the labels of a host as a negative number, or the segments of a path."""
    segments = F.size(F.filter(F.split(key, "/"), lambda step: step != "")) - 1
    return F.when(F.contains(key, F.lit("/")), segments).otherwise(-F.size(F.split(key, r"\.")))


def keys_of(url: Column, depths: Column | None = None) -> Column:
    """All entries that could cover a URL, or those of the ``depths`` (an array) that a list has."""
    parts = F.split(host_of(url), r"\.")
    steps = F.filter(F.split(path_of(url), "/"), lambda step: step != "")
    every = F.concat(
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: -n),
        F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps))).otherwise(F.array().cast("array<int>")),
    )
    if depths is not None:
        every = F.array_intersect(every, depths)
    keys = F.transform(
        every,
        lambda n: F.when(n < 0, F.array_join(F.slice(parts, F.size(parts) + n + 1, -n), ".")).otherwise(
            F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, F.lit(1), n), "/"))
        ),
    )
    return F.when(host_of(url) != "", F.array_distinct(keys))


def intervals(
    changes: DataFrame, entry_col: str = "entry", action_col: str = "action", time_col: str = "at", added: str = "add"
) -> DataFrame:
    """When each entry was active: key, ``from_time``, ``to_time`` (null: still active)."""
    named = changes.select(
        entry_key(F.col(f"`{entry_col}`")).alias("key"),
        (F.col(f"`{action_col}`") == added).alias("active"),
        F.col(f"`{time_col}`").alias("from_time"),
    ).dropna()
    states = named.groupBy("key", "from_time").agg(F.min("active").alias("active"))
    by_time = Window.partitionBy("key").orderBy("from_time")
    return states.withColumn("to_time", F.lead("from_time").over(by_time)).filter("active").drop("active")


def matches(captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched_at", **options) -> DataFrame:
    """Captures with each entry that covered them when they were fetched, as ``entry``; any number per capture."""
    key = fresh(captures, "entry")
    active = intervals(changes, **options)
    time = F.col(f"`{time_col}`")
    listed = entry_key(F.col(f"`{options.get('entry_col', 'entry')}`"))
    depths = fresh(captures, "list_depths")
    # One row, empty if nothing is listed.
    depth = changes.select(listed.alias("key")).filter("key IS NOT NULL").agg(F.collect_set(depth_of(F.col("key"))).alias(depths))
    keyed = captures.filter(time.isNotNull()).crossJoin(F.broadcast(depth))
    keyed = keyed.withColumn(key, F.explode(keys_of(F.col(f"`{url_col}`"), F.col(depths)))).drop(depths)
    names = {old: fresh(keyed, f"list_{old}") for old in active.columns}
    active = active.select(*[F.col(old).alias(new) for old, new in names.items()])
    start, end = F.col(names["from_time"]), F.col(names["to_time"])
    during = (keyed[key] == active[names["key"]]) & (time >= start) & (end.isNull() | (time < end))
    return keyed.join(active, during).drop(*names.values())


def verdicts(
    captures: DataFrame,
    changes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
    **options,
) -> DataFrame:
    """One row per capture: id, url, time, ``rows``, ``n_entries`` that covered it, the shortest ``entry``, ``blocked``."""
    named = captures.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{time_col}`").alias("time")
    )
    found = matches(named, changes, "url", "time", **options).select("id", "url", "time", "entry", F.lit(1).alias("hit"))
    # One row for each capture and each of its matches, brought together with sums formed before the shuffle.
    none = named.select("id", "url", "time", F.lit(None).cast("string").alias("entry"), F.lit(0).alias("hit"))
    rank = F.struct(F.char_length("entry").alias("length"), "entry")
    summed = found.unionByName(none).groupBy("id", "url", "time")
    summed = summed.agg(
        F.sum("hit").alias("hits"),
        F.sum(1 - F.col("hit")).alias("rows"),
        F.min(F.when(F.col("entry").isNotNull(), rank)).alias("first"),
    )
    return summed.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("time").alias(time_col),
        "rows",
        (F.col("hits") / F.greatest("rows", F.lit(1))).cast("long").alias("n_entries"),
        F.col("first.entry").alias("entry"),
        (F.col("hits") > 0).alias("blocked"),
    )


def allowed(captures: DataFrame, changes: DataFrame, url_col: str = "url", time_col: str = "fetched_at", **options) -> DataFrame:
    """The captures that no entry covered when they were fetched; columns as they came."""
    url, time = fresh(captures, "blocked_url"), fresh(captures, "blocked_time")
    named = captures.select(F.col(f"`{url_col}`").alias(url), F.col(f"`{time_col}`").alias(time)).distinct()
    found = matches(named, changes, url, time, **options).select(url, time).distinct()
    return captures.join(found, (captures[url_col] == found[url]) & (captures[time_col] == found[time]), "left_anti")
