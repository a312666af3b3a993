"""URL filters by a temporal list join, in DataFrame operations.

List entries are dated: they add a pattern to a list or take it off. They become
validity intervals, and every capture is evaluated against the entries that were active
when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Host of a URL with scheme, without user and port; then its path, without query and fragment.
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)"


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until`` from ``list, pattern, day, action``.

    ``add`` makes a pattern active from its day on, any other action ends that. Of two
    entries on one day the removal counts. ``until`` is the day of the pattern's next
    entry, null if there is none. Entries with a null are left out, repeated ones count
    once. A pattern is a host, which stands for its subdomains, too, or a host and the
    first segments of a path. One window holds the history of one pattern of one list.
    """
    known = entries.where("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND action IS NOT NULL")
    days = known.groupBy("list", F.lower(F.rtrim(F.col("pattern"), F.lit("/"))).alias("pattern"), "day").agg(
        F.min(F.col("action") == "add").alias("active")
    )
    history = W.partitionBy("list", "pattern").orderBy("day")
    dated = days.withColumn("until", F.lead("day").over(history))
    return dated.where("active").select("list", "pattern", F.col("day").alias("since"), "until")


def url_patterns(url, depth: int):
    """All patterns that match a URL: its host and parent domains, and the host with up to
    ``depth`` segments of its path."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    segments = F.slice(F.filter(F.split(F.lower(F.regexp_extract(url, _PATH, 1)), "/"), lambda s: s != ""), 1, depth)
    paths = F.transform(F.sequence(F.lit(0), F.size(segments)), lambda i: F.concat_ws("/", host, F.slice(segments, F.lit(1), i)))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths)))


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` with ``lists``, the names of all lists that the URL was on, sorted and
    joined by commas, and ``blocked``.

    Reads ``url`` and ``fetched`` (a date); columns ``lists`` and ``blocked`` are
    replaced, others stay. A null URL, one without host, and one without a date are on
    no list. An entry counts from its day until the day before it is taken off. All rows
    stay, repeated ones too. Equal captures are evaluated once, and a pattern is looked
    up once for each day; so a host with very many captures is no hot key of the join.
    """
    active = intervals(entries)
    depth = active.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    distinct = captures.select("url", "fetched").where("url IS NOT NULL AND fetched IS NOT NULL").distinct()
    looked = distinct.select("url", "fetched", F.explode(url_patterns(F.col("url"), depth)).alias("pattern"))
    asked = looked.select("pattern", "fetched").distinct()
    during = (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    on = asked.join(active, "pattern").where(during).select("pattern", "fetched", "list").distinct()
    hits = looked.join(on, ["pattern", "fetched"]).groupBy("url", "fetched").agg(F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"))
    return captures.drop("lists", "blocked").join(hits, ["url", "fetched"], "left").select(
        *[c for c in captures.columns if c not in ("lists", "blocked")],
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("lists").isNotNull().alias("blocked"),
    )
