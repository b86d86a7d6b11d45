"""The as-of join of captures and dated list entries against a plain loop."""

import datetime as dt
import random
from urllib.parse import urlsplit

from wayfold.llm import url_filters as U

CAPTURES = "page_id long, url string, fetched_on date"
ENTRIES = "pattern string, kind string, listed_on date"
ORDER = {U.BLOCK: 0, U.ALLOW: 1, U.REMOVE: 2}


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def plain_host(url):
    parts = urlsplit(url.lower()) if url else None
    if not parts or parts.scheme not in ("http", "https") or not parts.netloc:
        return None
    return parts.netloc.rpartition("@")[2].partition(":")[0].rstrip(".")


def judged(captures, entries):
    """Row by row: the newest entry of each pattern on the day, the longest pattern that blocks or allows."""
    usable = [(p.lower(), k, d) for p, k, d in entries if p is not None and d is not None and k in ORDER]
    for page, url, fetched in captures:
        host, best = plain_host(url), None
        if host is not None and fetched is not None:
            labels = host.split(".")
            for i in range(len(labels)):
                pattern = ".".join(labels[i:])
                states = [(d, -ORDER[k], k) for p, k, d in usable if p == pattern and d <= fetched]
                if states and max(states)[2] != U.REMOVE:
                    best = (pattern, max(states)[2])
                    break
        yield page, host, fetched, *(best or (None, None)), bool(best and best[1] == U.BLOCK)


def check(spark, captures, entries):
    got = U.as_of(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    key = lambda row: tuple(str(x) for x in row)
    assert sorted((tuple(r) for r in got), key=key) == sorted(judged(captures, entries), key=key)


def test_random_lists(spark):
    rng = random.Random(5)
    hosts = ["a.org", "b.a.org", "c.b.a.org", "d.net", "Net", "A.org"]
    entries = [(rng.choice(hosts), rng.choice(list(ORDER)), day(rng.randrange(40))) for _ in range(60)]
    captures = [
        (n, f"https://{rng.choice(hosts)}/{n}", day(rng.randrange(-2, 45))) for n in range(400)
    ]
    check(spark, captures, entries)


def test_borders_ties_and_odd_rows(spark):
    entries = [
        ("a.org", U.BLOCK, day(5)),
        ("a.org", U.REMOVE, day(9)),
        ("b.org", U.ALLOW, day(5)),
        ("b.org", U.BLOCK, day(5)),
        ("b.org", U.BLOCK, day(5)),
        ("x.b.org", U.ALLOW, day(6)),
        (None, U.BLOCK, day(1)),
        ("a.org", None, day(1)),
        ("a.org", "other", day(1)),
        ("a.org", U.BLOCK, None),
    ]
    captures = [(n, "http://a.org/", day(n)) for n in range(3, 12)]
    captures += [(n, "http://x.b.org:80/?q=a.org", day(n)) for n in (4, 5, 6)]
    captures += [(1, None, day(6)), (None, "http://user@B.ORG./", day(6)), (2, "http://a.org", None), (3, "", day(6))]
    captures += [(4, "ftp://a.org", day(6)), (5, "http://a.org/" + "y" * 100_000, day(6)), (6, "http:///none", day(6))]
    check(spark, captures + captures[:3], entries)


def test_empty_tables(spark):
    check(spark, [], [("a.org", U.BLOCK, day(1))])
    check(spark, [(1, "http://a.org", day(2))], [])


def test_extra_columns_that_clash(spark):
    captures = spark.createDataFrame(
        [(1, "http://a.org", day(2), "p", "k", True)], f"{CAPTURES}, pattern string, kind string, blocked boolean"
    )
    entries = spark.createDataFrame(
        [("a.org", U.BLOCK, day(1), day(0), "h")], f"{ENTRIES}, valid_from date, host string"
    )
    assert [tuple(r) for r in U.as_of(captures, entries).collect()] == [
        (1, "a.org", day(2), "a.org", U.BLOCK, True)
    ]
