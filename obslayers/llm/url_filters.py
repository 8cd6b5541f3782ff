"""URL filters by a temporal list join (operator 7), in built-in functions only.

A list has dated entries: from a day on, a pattern is blocked, allowed, or off the list.
Entries of one pattern become intervals that do not overlap. A capture is judged by the
entry that was active on the day it was fetched: its URL's patterns (the host and its
parent domains, the path and its parents) are joined to the intervals on pattern and month,
so a pattern of long history costs a capture no more than one month of it. Of several
matches the most specific one decides.

URLs fetched more than once on a day are looked up once. A list that Spark finds small is
broadcast; a large one is dealt out, where the join may split hot patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslayers.llm.quality_classifier import free_name

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"
RESULT = ("list_pattern", "list_action", "blocked")


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (``pattern``, ``action``, ``since``, ``until``) of ``entries`` (``pattern``, ``action``, ``listed_on``).

    ``until`` is the first day on which the entry no longer holds, null for the last. Of
    entries of one pattern and day the alphabetically last action holds. Entries with a
    null are left out. A pattern has one entry a day at most, which bounds its group by
    the length of the list's history.
    """
    whole = entries.where("pattern IS NOT NULL AND action IS NOT NULL AND listed_on IS NOT NULL")
    daily = whole.groupBy("pattern", "listed_on").agg(F.max("action").alias("action"))
    following = F.lead("listed_on").over(Window.partitionBy("pattern").orderBy("listed_on"))
    return daily.select("pattern", "action", F.col("listed_on").alias("since"), following.alias("until")).where(
        F.col("action") != REMOVE
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def patterns(url: Column) -> Column:
    """All patterns that match a URL: parent domains, and its host with parent paths.

    ``a.b.org`` for the host and all below it; ``a.b.org/x/y`` for that path and all below it.
    """
    labels = F.split(host(url), r"\.")
    domains = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    below = F.transform(steps, lambda _, i: F.concat_ws("/", F.array(host(url)), F.slice(steps, 1, i + 1)))
    return F.when(host(url) != "", F.array_distinct(F.concat(domains, below)))


def judge_captures(
    captures: DataFrame, entries: DataFrame, url_column: str = "url", time_column: str = "fetched_at"
) -> DataFrame:
    """``captures`` with ``list_pattern``, ``list_action`` and ``blocked``, which replace columns of those names.

    A capture with no active entry, no host or no fetch time has a null pattern and action
    and is not blocked. Repeated captures are all kept. Of several active entries that with
    a path comes before one without, and the longer pattern before the shorter.
    """
    url, day = captures[url_column], F.to_date(captures[time_column])
    wanted = captures.select(url.alias("u"), day.alias("d")).distinct().where("u IS NOT NULL AND d IS NOT NULL")
    asked = wanted.withColumn("pattern", F.explode(patterns(F.col("u"))))
    asked = asked.withColumn("month", F.trunc("d", "month"))
    last = captures.agg(F.max(day)).first()[0]
    intervals = validity(entries).where(F.col("since") <= F.lit(last).cast("date"))
    end = F.least(F.date_sub("until", 1), F.lit(last).cast("date"))
    end = F.coalesce(end, F.lit(last).cast("date"))
    months = F.sequence(F.trunc("since", "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    by_month = intervals.withColumn("month", F.explode(months))
    active = (F.col("d") >= F.col("since")) & (F.col("until").isNull() | (F.col("d") < F.col("until")))
    met = asked.join(by_month, ["pattern", "month"]).where(active)
    rank = F.struct(F.col("pattern").contains("/").alias("path"), F.length("pattern").alias("n"), "pattern", "action")
    best = met.groupBy("u", "d").agg(F.max(rank).alias("best"))
    # Under names that no column of the captures has.
    of_url, of_day, found = (free_name(captures, name) for name in ("u", "d", "best"))
    best = best.select(F.col("u").alias(of_url), F.col("d").alias(of_day), F.col("best").alias(found))
    joined = captures.join(best, (url == F.col(of_url)) & (day == F.col(of_day)), "left")
    action = F.col(found)["action"]
    return joined.select(
        *[captures[c] for c in captures.columns if c not in RESULT],
        F.col(found)["pattern"].alias("list_pattern"),
        action.alias("list_action"),
        F.coalesce(action == BLOCK, F.lit(False)).alias("blocked"),
    )


# -- the query's captures and list, made from the pages ------------------------------


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages have no fetch time: it follows from the id, over the year 2024."""
    hours = F.pmod(F.coalesce("page_id", F.lit(0)) * 7919, F.lit(8760))
    at = F.timestamp_seconds(F.lit(1704067200) + hours * 3600)
    return pages.select("page_id", "url", at.alias("fetched_at"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A dated list over all hosts, parent domains and first paths that the pages have.

    Days follow from the patterns' letters: blocked from one, changed on a second, blocked
    again or removed on a third.
    """
    url = F.col("url")
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    listed = F.array(
        host(url),
        F.regexp_extract(host(url), r"([^.]+\.[^.]+\.[^.]+)$", 1),
        F.when(path != "", F.concat_ws("/", host(url), path)),
    )
    names = pages.select(F.explode(listed).alias("pattern")).where("pattern <> ''").distinct()
    p = F.col("pattern")
    seed = F.length(p) * 37 + F.ascii(F.substring(p, 1, 1)) * 11 + F.ascii(F.substring(p, 3, 1)) * 5
    first = F.date_add(F.lit("2023-12-01").cast("date"), (seed % 200).cast("int"))
    entries = F.array(
        F.struct(first.alias("listed_on"), F.lit(BLOCK).alias("action")),
        F.struct(
            F.date_add(first, (seed % 71 + 10).cast("int")).alias("listed_on"),
            F.when(seed % 2 == 0, ALLOW).otherwise(REMOVE).alias("action"),
        ),
        F.struct(
            F.date_add(first, (seed % 53 + 120).cast("int")).alias("listed_on"),
            F.when(seed % 3 == 0, REMOVE).otherwise(BLOCK).alias("action"),
        ),
    )
    return names.select("pattern", F.explode(entries).alias("e")).select("pattern", "e.*")


ORACLE_SQL = r"""
WITH hosts AS (
    SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
        regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
        TIMESTAMP '2024-01-01' + to_hours((coalesce(page_id, 0) * 7919) % 8760) AS fetched_at
    FROM pages
), names AS (
    SELECT host AS pattern FROM hosts
    UNION SELECT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM hosts
    UNION SELECT host || '/' || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) FROM hosts
        WHERE regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) <> ''
), seeded AS (
    SELECT pattern, CAST(length(pattern) * 37 + ascii(substr(pattern, 1, 1)) * 11 + ascii(substr(pattern, 3, 1)) * 5 AS INTEGER) AS seed
    FROM names WHERE pattern <> ''
), entries AS (
    SELECT pattern, DATE '2023-12-01' + seed % 200 AS listed_on, 'block' AS action FROM seeded
    UNION ALL SELECT pattern, DATE '2023-12-01' + seed % 200 + seed % 71 + 10,
        CASE WHEN seed % 2 = 0 THEN 'allow' ELSE 'remove' END FROM seeded
    UNION ALL SELECT pattern, DATE '2023-12-01' + seed % 200 + seed % 53 + 120,
        CASE WHEN seed % 3 = 0 THEN 'remove' ELSE 'block' END FROM seeded
), daily AS (
    SELECT pattern, listed_on, max(action) AS action FROM entries GROUP BY ALL
), asked AS (
    SELECT page_id, url, fetched_at, unnest(list_distinct(list_concat(
        list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
        list_transform(range(1, len(list_filter(string_split(path, '/'), lambda s: s <> '')) + 1),
            lambda i: host || '/' || array_to_string(list_filter(string_split(path, '/'), lambda s: s <> '')[:i], '/'))
    ))) AS pattern FROM hosts WHERE host <> ''
), met AS (
    SELECT a.page_id, a.pattern, d.action,
        row_number() OVER (PARTITION BY a.page_id, a.pattern ORDER BY d.listed_on DESC) AS r
    FROM asked AS a JOIN daily AS d ON a.pattern = d.pattern AND d.listed_on <= CAST(a.fetched_at AS DATE)
), best AS (
    SELECT page_id, pattern, action,
        row_number() OVER (PARTITION BY page_id ORDER BY contains(pattern, '/') DESC, length(pattern) DESC, pattern DESC) AS k
    FROM met WHERE r = 1 AND action <> 'remove'
)
SELECT h.page_id, h.url, h.fetched_at, b.pattern AS list_pattern, b.action AS list_action,
    coalesce(b.action = 'block', false) AS blocked
FROM hosts AS h LEFT JOIN best AS b ON h.page_id = b.page_id AND b.k = 1"""
