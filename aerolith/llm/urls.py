"""URL filters over time: each capture is judged by the list entries active when it was fetched.

Lists grow and shrink. A dated entry says that a list adds or removes a key, and it holds from its
day until the next entry of the same list, scope and key: so entries become validity intervals.
Which interval holds at a fetch day is an as-of join on (list, scope, key).

Captures are reduced first to distinct (host, day) pairs and, for the join itself, to distinct
(key, day) pairs of the host and its parent domains. A host with a third of all captures is then at
most one row per day, and so is a domain with any number of hosts; only the last join, which takes
the verdicts back to the captures, sees all of them, and adaptive execution splits that one.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolith.session import stored

ADD, REMOVE = "add", "remove"
HOST, DOMAIN = "host", "domain"

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without port, user or closing dot; null if there is none.

    Read as browsers do: white space and control characters around the URL go, and a backslash is a
    slash. A URL without a scheme has no host.
    """
    plain = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), "\\", "/")
    host = F.rtrim(F.lower(F.regexp_extract(plain, _AUTHORITY, 1)), F.lit("."))
    return F.nullif(host, F.lit(""))


def keys_of(host: Column, most_labels: int) -> Column:
    """The host and its parent domains of at most `most_labels` labels, the top level left out unless
    it is the host. Lists have no longer keys, so a host of very many labels has no more parents."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(
        F.sequence(F.greatest(n - (max(most_labels, 2) - 1), F.lit(1)), F.greatest(n - 1, F.lit(1))),
        lambda at: F.array_join(F.slice(labels, at, n), "."),
    )
    return parents


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, scope, key, day, action) entries to (list, scope, key, valid_from, valid_to, active).

    valid_to is the day of the next entry, null for the last. Of entries of one day an addition wins,
    and repeated entries count once. Entries with a null are left out.
    """
    usable = entries.select("list", "scope", "key", "day", "action").dropna()
    daily = usable.groupBy("list", "scope", "key", "day").agg(
        F.max(F.col("action") == ADD).alias("active")
    )
    order = Window.partitionBy("list", "scope", "key").orderBy("day")
    return daily.select(
        "list", "scope", "key",
        F.col("day").alias("valid_from"), F.lead("day").over(order).alias("valid_to"), "active",
    )


def active_at(probes: DataFrame, intervals: DataFrame) -> DataFrame:
    """As-of join: for distinct (key, day) probes, the active interval of each list and scope that
    has the key. Probes and intervals of a key are merged by day, and each probe takes the last
    interval begun. A key has at most a row per day and list here."""
    listed = intervals.select("list", "scope", "key").distinct()
    asked = probes.join(listed, "key").select(
        "list", "scope", "key", "day", F.lit(1).alias("probe"),
        F.lit(None).cast("struct<valid_from:date,valid_to:date,active:boolean>").alias("interval"),
    )
    begun = intervals.select(
        "list", "scope", "key", F.col("valid_from").alias("day"), F.lit(0).alias("probe"),
        F.struct("valid_from", "valid_to", "active").alias("interval"),
    )
    order = Window.partitionBy("list", "scope", "key").orderBy("day", "probe")
    last = F.last("interval", ignorenulls=True).over(order)
    merged = asked.unionByName(begun).withColumn("_held", last)
    return merged.filter("probe = 1 AND _held.active").select(
        "list", "scope", "key", "day", "_held.valid_from", "_held.valid_to"
    )


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per row of `captures` (page_id, url, fetch_date): page_id, host, fetch_date, blocked
    and the entry that blocks: the most specific key, a host entry before a domain entry, then the
    first list by name.

    Captures without host or fetch date are not blocked. A domain entry covers the host of that name
    and all below it, a host entry that host alone. Repeated rows are each judged; other columns are
    not read.
    """
    rows = stored(
        captures.select("page_id", host_of(F.col("url")).alias("host"), "fetch_date"), "url-captures"
    )
    visits = rows.filter("host IS NOT NULL AND fetch_date IS NOT NULL").select(
        "host", F.col("fetch_date").alias("day")
    ).distinct()
    intervals = stored(validity_intervals(entries), "url-intervals")
    most = intervals.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first()["n"] or 0
    keyed = visits.select("host", "day", F.explode(keys_of(F.col("host"), most)).alias("key"))
    active = active_at(keyed.select("key", "day").distinct(), intervals)
    covers = (F.col("scope") == DOMAIN) | (F.col("key") == F.col("host"))
    best = F.min(
        F.struct(
            (-F.length("key")).alias("rank"), (F.col("scope") != HOST).alias("wide"), "list", "scope",
            "key", "valid_from", "valid_to",
        )
    )
    verdicts = keyed.join(active, ["key", "day"]).filter(covers).groupBy("host", "day").agg(best.alias("hit"))
    verdicts = verdicts.withColumnRenamed("host", "_host")
    joined = rows.join(verdicts, (F.col("host") == F.col("_host")) & (F.col("fetch_date") == F.col("day")), "left")
    return joined.select(
        "page_id", "host", "fetch_date", F.col("hit").isNotNull().alias("blocked"),
        "hit.list", "hit.scope", "hit.key", "hit.valid_from", "hit.valid_to",
    )
