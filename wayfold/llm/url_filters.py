"""Temporal URL lists: dated entries become validity intervals, captures are judged as of their fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What an entry can say about its pattern; a removal ends the entry before it.
BLOCK, ALLOW, REMOVE = "block", "allow", "remove"


def host_of(url: Column) -> Column:
    """Lower-case host of an http or https address, without port and user; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.when(host != "", F.regexp_replace(host, r"\.+$", ""))


def suffixes(host: Column) -> Column:
    """The host and all domains above it: a.b.org, b.org, org."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(pattern, kind, valid_from, valid_to) of entries (pattern, kind, listed_on).

    An entry holds from its date to the day of the pattern's next entry, or for ever (null). Of several
    entries of a pattern on a day, block counts before allow and allow before remove. Entries with a null
    or of another kind are ignored. A pattern has one entry a day at most after that, which bounds a window.
    """
    rank = F.when(F.col("kind") == BLOCK, 0).when(F.col("kind") == ALLOW, 1).otherwise(2)
    daily = (
        entries.filter(F.col("kind").isin(BLOCK, ALLOW, REMOVE))
        .filter("pattern is not null and listed_on is not null")
        .groupBy(F.lower("pattern").alias("pattern"), F.col("listed_on").cast("date").alias("valid_from"))
        .agg(F.min(F.struct(rank.alias("rank"), "kind"))["kind"].alias("kind"))
    )
    later = Window.partitionBy("pattern").orderBy("valid_from")
    return (
        daily.withColumn("valid_to", F.lead("valid_from").over(later))
        .filter(F.col("kind") != REMOVE)
        .select("pattern", "kind", "valid_from", "valid_to")
    )


def as_of(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, host, fetched_on, pattern, kind, blocked) for each row of captures (page_id, url, fetched_on).

    Of the entries active on the day of the fetch whose pattern is the host or a domain above it, the longest
    pattern decides. Captures without such an entry, without a host or without a date are not blocked, and
    their pattern and kind are null. Repeated rows are judged alike; other columns are ignored.

    Hosts are judged once per day, so a host with many captures is no hot key of the interval join.
    """
    seen = captures.select(
        "page_id", host_of(F.col("url")).alias("host"), F.col("fetched_on").cast("date").alias("fetched_on")
    )
    days = seen.filter("host is not null and fetched_on is not null").select("host", "fetched_on").distinct()
    intervals = validity_intervals(entries)
    active = (
        days.select("host", "fetched_on", F.explode(suffixes(F.col("host"))).alias("pattern"))
        .join(intervals, "pattern")
        .filter("valid_from <= fetched_on and (valid_to is null or fetched_on < valid_to)")
    )
    decided = active.groupBy("host", "fetched_on").agg(
        F.max(F.struct(F.length("pattern").alias("size"), "pattern", "kind")).alias("best")
    )
    return seen.join(decided, ["host", "fetched_on"], "left").select(
        "page_id",
        "host",
        "fetched_on",
        F.col("best.pattern").alias("pattern"),
        F.col("best.kind").alias("kind"),
        F.coalesce(F.col("best.kind") == BLOCK, F.lit(False)).alias("blocked"),
    )
