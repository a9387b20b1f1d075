"""URL filters: temporal list join.

Dated list entries (added, removed) become validity intervals, and every capture is evaluated against the entries
that were active when it was fetched.  An entry names a host, a domain with all hosts below it, or a host with
leading path segments.

A url has one key per host suffix and per path prefix.  Keys meet intervals by an equi join on key and month, an
interval standing in each month it touches, so the pairs looked at do not grow with the length of a key's history.
Distinct (url, day) pairs are evaluated instead of captures, and history is combined per day before it is
ordered, so neither a hot host nor a hot entry puts its rows into one task.

Of entries with several events on one day the removal counts last.  An addition while active starts a new
interval.  Events with a null list, pattern, action or day are no events.  A null url or day of fetching matches
nothing: the capture is returned as not blocked.  Repeated captures are returned as often as they come in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.template_removal import host_of


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list, pattern, since, until) from events (list, pattern, action 'add' or 'remove', day); until is exclusive, null if open."""
    days = (events.where("list is not null and pattern is not null and day is not null and action in ('add', 'remove')")
            .groupBy("list", "pattern", "day").agg(F.max("action").alias("action")))
    following = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return (days.select("list", "pattern", "action", F.col("day").alias("since"), following.alias("until"))
            .where("action = 'add'").drop("action"))


def url_keys(url):
    """Host suffixes and host + path prefixes of a url column, without scheme, user, port, query and fragment."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    prefixes = F.when(F.size(parts) > 0, F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.when(host != "", F.concat(suffixes, F.coalesce(prefixes, F.array().cast("array<string>"))))


def evaluate(captures: DataFrame, intervals: DataFrame) -> DataFrame:
    """`captures` (with url, fetched) with blocked, n_entries, and list, pattern, listed_since of the most specific active entry.

    Columns of `captures` with one of these names are replaced."""
    captures = captures.drop("blocked", "n_entries", "list", "pattern", "listed_since")
    asked = captures.select("url", "fetched").where("url is not null and fetched is not null").distinct()
    keys = asked.select("url", "fetched", F.explode(url_keys(F.col("url"))).alias("key")).withColumn("month", F.trunc("fetched", "month"))
    last = F.lit(asked.agg(F.trunc(F.max("fetched"), "month").alias("last")).first()["last"]).cast("date")
    spans = (intervals.withColumn("end", F.least(F.coalesce(F.trunc(F.date_sub("until", 1), "month"), last), last))
             .withColumn("start", F.trunc("since", "month")).where("start <= end")
             .withColumn("month", F.explode(F.sequence("start", "end", F.expr("interval 1 month"))))
             .select(F.col("pattern").alias("key"), "month", "list", "since", "until"))
    active = (keys.join(spans, ["key", "month"]).where("since <= fetched and (until is null or fetched < until)")
              .groupBy("url", "fetched").agg(
                  F.count("*").alias("n_entries"),
                  F.min(F.struct((-F.length("key")).alias("order"), "list", F.col("key").alias("pattern"), F.col("since").alias("since"))).alias("best")))
    found = active.select("url", "fetched", "n_entries", F.col("best.list").alias("list"), F.col("best.pattern").alias("pattern"),
                          F.col("best.since").alias("listed_since"))
    return (captures.join(found, ["url", "fetched"], "left")
            .withColumn("n_entries", F.coalesce("n_entries", F.lit(0)))
            .withColumn("blocked", F.col("n_entries") > 0))
