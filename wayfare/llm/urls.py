"""URL filter lists by date, with DataFrame functions only.

A list is a log of dated entries: on a day, a domain or a URL prefix was added to a category or
taken off it. Per entry key the log becomes validity intervals that do not overlap. A capture
looks up its host, every parent domain and every path prefix, as of the day it was fetched.

The as-of join is an equi-join on (key, period): an interval is listed in every period it
overlaps, within the days that captures have, and a capture belongs to one period. Captures are
first reduced to distinct (host, path keys, day), so a host with very many captures meets the list
once a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import fields_of, quoted
from wayfare.session import materialise

# Days per period of the equi-join.
PERIOD_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, or trailing dot; empty if there is none."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    authority = F.when(rest.startswith("//"), F.regexp_extract(rest, r"^//([^/?#]*)", 1))
    name = F.regexp_replace(F.coalesce(authority, F.lit("")), r"^.*@", "")
    return F.lower(F.regexp_replace(F.regexp_replace(name, r":[0-9]*$", ""), r"\.$", ""))


def path_of(url: Column) -> Column:
    """Path without query and fragment; `/` if there is none."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)?", 1)
    return F.when(path == "", "/").otherwise(path)


def intervals(entries: DataFrame) -> DataFrame:
    """(category, key, since, until) from (category, key, day, active); until is exclusive.

    Several entries of one key and day: a removal wins. Entries that change nothing do not cut an
    interval; the last one stays open, with a null end. Entries with a null key, category
    or day have no effect; a null `active` is a removal.
    """
    log = entries.filter("key IS NOT NULL AND category IS NOT NULL AND day IS NOT NULL")
    # One row per key and day, however often an entry was repeated.
    daily = log.groupBy("category", "key", "day").agg(
        F.min(F.coalesce(F.col("active"), F.lit(False))).alias("active")
    )
    order = Window.partitionBy("category", "key").orderBy("day")
    changes = daily.withColumn("_before", F.lag("active", 1, False).over(order)).filter(
        "active <> _before"
    )
    spans = changes.withColumn("until", F.lead("day").over(order)).filter("active")
    return spans.select("category", "key", F.col("day").alias("since"), "until")


def keys_of(host: Column, path: Column, depth: int) -> Column:
    """Entry keys of a capture: its domains, then host/path prefixes of up to `depth` segments."""
    labels = F.split(host, r"\.", -1)
    domains = F.when(
        host != "",
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))
    segments = F.filter(F.split(F.substring_index(path, "/", depth + 1), "/", -1), lambda s: s != "")
    count = F.least(F.size(segments), F.lit(depth))
    prefixes = F.when(
        (host != "") & (count > 0),
        F.transform(
            F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
            lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(domains, prefixes))


def blocked(
    captures: DataFrame,
    entries: DataFrame,
    url_column: str = "url",
    day_column: str = "fetched",
    period_days: int = PERIOD_DAYS,
) -> DataFrame:
    """`captures` with the categories whose list held them on the day they were fetched.

    Adds `host`, `n_entries`, `categories` (sorted, comma-joined, empty if none) and `since`, the
    first day of the oldest interval that applies. A capture with a null day, a null or empty
    url or no host meets no entry. Rows may repeat. A column of these names in `captures` is
    replaced. No captures or no entries give no matches.
    """
    captures = captures.drop("host", "n_entries", "categories", "since")
    url, day = (F.col(quoted(c)) for c in (url_column, day_column))
    marked = captures.select(
        F.struct(*(F.col(quoted(c)) for c in captures.columns)).alias("_doc"),
        host_of(url).alias("_host"), path_of(url).alias("_path"), day.cast("date").alias("_day"),
    )
    valid = materialise(intervals(entries))
    # The deepest prefix on the list bounds how many keys a long path has.
    (deepest,) = valid.agg(F.max(F.size(F.split("key", "/", -1)) - 1)).first()
    depth = int(deepest or 0)
    start = F.substring_index("_path", "/", depth + 1) if depth else F.lit("")
    marked = materialise(marked.withColumn("_path", start))
    first, last = marked.agg(F.min("_day"), F.max("_day")).first()
    wanted = marked.filter("_day IS NOT NULL AND _host IS NOT NULL AND _host <> ''")
    wanted = wanted.select("_host", "_path", "_day").distinct()
    period = lambda day: F.floor(F.datediff(day, F.lit("1970-01-01")) / period_days)
    asked = wanted.select(
        "*", F.explode(keys_of(F.col("_host"), F.col("_path"), depth)).alias("key"),
        period(F.col("_day")).alias("_period"),
    )
    # Intervals are cut to the days of the captures, so an open end does not go on for ever.
    lowest, highest = F.lit(first).cast("date"), F.lit(last).cast("date")
    listed = valid.filter((F.col("since") <= highest) & (F.coalesce("until", highest + 1) > lowest))
    listed = listed.select(
        "*",
        F.explode(
            F.sequence(
                period(F.greatest("since", lowest)),
                period(F.least(F.coalesce(F.date_sub("until", 1), highest), highest)),
            )
        ).alias("_period"),
    )
    applies = (F.col("_day") >= F.col("since")) & (
        F.col("until").isNull() | (F.col("_day") < F.col("until"))
    )
    met = asked.join(listed, ["key", "_period"]).filter(applies)
    decided = materialise(
        met.groupBy("_host", "_path", "_day").agg(
            F.count(F.lit(1)).alias("n_entries"),
            F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
            F.min("since").alias("since"),
        )
    )
    return marked.join(decided, ["_host", "_path", "_day"], "left").select(
        *fields_of(marked), F.col("_host").alias("host"), F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        F.coalesce("categories", F.lit("")).alias("categories"), "since",
    )


# -- the registered query --------------------------------------------------------------------

FIRST_DAY = "2023-01-01"
CAPTURE_DAYS = 730


def captures_from(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day. The table has none, so it follows from the page's number."""
    day = F.pmod(F.col("page_id") * 37, F.lit(CAPTURE_DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), day).alias("fetched"))


def entries_from(pages: DataFrame) -> DataFrame:
    """A dated list made from all pages of the table.

    For each host: its number of pages and its least page number say when it was listed as
    spam or adult, when it was taken off and when it was listed again. Every host with a
    page whose number is a multiple of 7 has the first path segment of its first such page
    listed as a prefix, and every parent domain of four or more labels is listed for a while.
    """
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = hosts.filter("host <> ''")
    stats = hosts.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.min("page_id").alias("low"), F.max("page_id").alias("high")
    )
    start = F.lit(FIRST_DAY).cast("date")

    def entry(category: Column, key: Column, day: Column, active: bool) -> Column:
        return F.struct(
            category.alias("category"), key.alias("key"),
            F.date_add(start, F.pmod(day, F.lit(CAPTURE_DAYS)).cast("int")).alias("day"),
            F.lit(active).alias("active"),
        )

    category = F.when(F.col("low") % 2 == 0, "spam").otherwise("adult")
    by_host = stats.select(
        F.inline(
            F.array(
                entry(category, F.col("host"), F.col("low") * 13, True),
                entry(category, F.col("host"), F.col("low") * 13 + F.col("n"), False),
                entry(category, F.col("host"), F.col("high") * 11, True),
                entry(F.lit("tracker"), F.col("host"), F.col("high") * 5, True),
                entry(F.lit("tracker"), F.col("host"), F.col("high") * 5 + 100, False),
            )
        )
    )
    sevenths = hosts.filter("page_id % 7 = 0").groupBy("host").agg(
        F.min_by(F.element_at(F.split("path", "/", -1), 2), "page_id").alias("segment"),
        F.min("page_id").alias("low"),
    )
    prefix = F.concat("host", F.lit("/"), "segment")
    by_prefix = sevenths.filter("segment <> ''").select(
        F.inline(F.array(entry(F.lit("path"), prefix, F.col("low") * 3, True)))
    )
    labels = F.split("host", r"\.", -1)
    parents = stats.filter(F.size(labels) >= 4).select(
        F.array_join(F.slice(labels, 2, F.size(labels)), ".").alias("host"), "n"
    ).groupBy("host").agg(F.sum("n").alias("n"))
    by_parent = parents.select(
        F.inline(
            F.array(
                entry(F.lit("network"), F.col("host"), F.col("n") * 17, True),
                entry(F.lit("network"), F.col("host"), F.col("n") * 17 + 200, False),
            )
        )
    )
    return by_host.unionByName(by_prefix).unionByName(by_parent)


SQL = f"""
WITH hosts AS (
  SELECT page_id, lower(regexp_replace(regexp_replace(regexp_replace(
      CASE WHEN starts_with(rest, '//') THEN regexp_extract(rest, '^//([^/?#]*)', 1) ELSE '' END,
      '^.*@', ''), ':[0-9]*$', ''), '\\.$', '')) AS host,
    CASE WHEN path = '' THEN '/' ELSE path END AS path,
    DATE '{FIRST_DAY}' + CAST((page_id * 37) % {CAPTURE_DAYS} AS INTEGER) AS fetched
  FROM (
    SELECT page_id, regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:', '') AS rest,
      regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)?', 1) AS path
    FROM pages
  )
), stats AS (
  SELECT host, count(*) AS n, min(page_id) AS low, max(page_id) AS high,
    CASE WHEN min(page_id) % 2 = 0 THEN 'spam' ELSE 'adult' END AS category
  FROM hosts WHERE host <> '' GROUP BY host
), parents AS (
  SELECT array_to_string(string_split(host, '.')[2:], '.') AS host, sum(n) AS n
  FROM stats WHERE len(string_split(host, '.')) >= 4 GROUP BY 1
), sevenths AS (
  SELECT host, min_by(string_split(path, '/')[2], page_id) AS segment, min(page_id) AS low
  FROM hosts WHERE host <> '' AND page_id % 7 = 0 GROUP BY host
), log AS (
  SELECT category, host AS key, low * 13 AS day, TRUE AS active FROM stats
  UNION ALL SELECT category, host, low * 13 + n, FALSE FROM stats
  UNION ALL SELECT category, host, high * 11, TRUE FROM stats
  UNION ALL SELECT 'tracker', host, high * 5, TRUE FROM stats
  UNION ALL SELECT 'tracker', host, high * 5 + 100, FALSE FROM stats
  UNION ALL SELECT 'path', host || '/' || segment, low * 3, TRUE FROM sevenths WHERE segment <> ''
  UNION ALL SELECT 'network', host, n * 17, TRUE FROM parents
  UNION ALL SELECT 'network', host, n * 17 + 200, FALSE FROM parents
), daily AS (
  SELECT category, key, DATE '{FIRST_DAY}' + CAST(day % {CAPTURE_DAYS} AS INTEGER) AS day,
    bool_and(active) AS active
  FROM log GROUP BY ALL
), changes AS (
  SELECT * FROM (
    SELECT *, lag(active, 1, FALSE) OVER (PARTITION BY category, key ORDER BY day) AS before
    FROM daily
  ) WHERE active <> before
), valid AS (
  SELECT category, key, day AS since, until FROM (
    SELECT *, lead(day) OVER (PARTITION BY category, key ORDER BY day) AS until FROM changes
  ) WHERE active
), met AS (
  SELECT h.page_id, v.category, v.since FROM hosts AS h JOIN valid AS v
  ON (h.host = v.key OR ends_with(h.host, '.' || v.key)
      OR starts_with(h.host || h.path || '/', v.key || '/') AND contains(v.key, '/'))
    AND h.fetched >= v.since AND (v.until IS NULL OR h.fetched < v.until)
), decided AS (
  SELECT page_id, count(*) AS n_entries, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
    min(since) AS since
  FROM met GROUP BY page_id
)
SELECT h.page_id, h.host, CAST(h.fetched AS VARCHAR) AS fetched,
  coalesce(n_entries, 0) AS n_entries, coalesce(categories, '') AS categories,
  CAST(since AS VARCHAR) AS since
FROM hosts AS h LEFT JOIN decided USING (page_id)"""
