"""URL filters with a dated list: entries become validity intervals, captures are judged as of their fetch.

A list event adds or removes a domain for a category from a day on; of several on one day a
removal counts last. An added domain stays listed until the next event for it. A capture
matches a domain if its host is the domain or lies below it; of the entries active at the fetch
the one with most characters is reported (then the last domain and category by name).

Every capture is joined on equal domains with the interval as a further condition, so no pair
of a capture and an inactive entry leaves the join. Spark decides by its size whether to broadcast the
list; a hot host is split by adaptive execution.

Defined results: URLs without a host, null URLs and null fetch times are never blocked. List events
with a null domain or day are ignored. Repeated captures are one row with their number in ``n_captures``.
Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"

# The dated list that the registered query applies.
EVENTS = (
    ("spam-farm.example.org", "spam", "2024-01-15", "add"),
    ("spam-farm.example.org", "spam", "2024-06-01", "remove"),
    ("spam-farm.example.org", "spam", "2024-09-01", "add"),
    ("cheap-pills.example.com", "pharmacy", "2024-03-01", "add"),
    ("example.net", "parked", "2024-05-10", "add"),
    ("example.net", "parked", "2024-05-20", "remove"),
    ("blog.ththan.example.net", "adult", "2024-02-01", "add"),
    ("blog.ththan.example.net", "adult", "2024-02-01", "remove"),
    ("therin.example.net", "malware", "2024-04-01", "add"),
    ("therin.example.net", "malware", "2024-07-01", "add"),
    ("therin.example.net", "phishing", "2024-08-01", "add"),
)


def events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENTS, "domain string, category string, day string, action string").withColumn("day", F.to_date("day"))


def intervals(listed: DataFrame) -> DataFrame:
    """(domain, category, since, until): when each entry holds; until is exclusive, null for ever."""
    days = listed.where("domain is not null and day is not null").groupBy(F.lower("domain").alias("domain"), "category", "day").agg(F.max("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy("domain", "category").orderBy("day"))
    return days.select("domain", "category", F.col("day").alias("since"), following.alias("until"), "action").where("action = 'add'").drop("action")


def judge(captures: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, url, fetched_at, host, n_captures, blocked, matched_domain, category."""
    keys = ["page_id", "url", "fetched_at"]
    host = F.nullif(F.regexp_extract(F.lower("url"), HOST, 1), F.lit(""))
    one = captures.groupBy(*keys).agg(F.count("*").alias("n_captures")).withColumn("host", host)
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    asked = one.select("*", F.explode_outer(above).alias("domain"))
    held = intervals(listed)
    active = (asked["domain"] == held["domain"]) & (asked["fetched_at"] >= held["since"]) & (held["until"].isNull() | (asked["fetched_at"] < held["until"]))
    found = asked.join(held, active, "left").groupBy(*keys, "host", "n_captures").agg(F.max(F.when(held["domain"].isNotNull(), F.struct(F.length(held["domain"]).alias("size"), held["domain"].alias("domain"), held["category"].alias("category")))).alias("m"))
    return found.select(*keys, "host", "n_captures", F.col("m").isNotNull().alias("blocked"), F.col("m")["domain"].alias("matched_domain"), F.col("m")["category"].alias("category"))


def captured(pages: DataFrame) -> DataFrame:
    """The pages as captures; the table has no fetch times, so they are spread over 2024 by page_id."""
    return pages.select("page_id", "url", F.expr("date_add(DATE '2024-01-01', cast(pmod(page_id, 366) as int))").alias("fetched_at"))


ORACLE = f"""
WITH ev(domain, category, day, action) AS (VALUES {', '.join(f"('{d}', '{c}', DATE '{t}', '{a}')" for d, c, t, a in EVENTS)}),
days AS (SELECT domain, category, day, max(action) AS action FROM ev GROUP BY ALL),
held AS (SELECT domain, category, day AS since, lead(day) OVER (PARTITION BY domain, category ORDER BY day) AS until, action FROM days),
one AS (SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_at, nullif(regexp_extract(lower(url), '{HOST}', 1), '') AS host, count(*) AS n_captures FROM pages GROUP BY ALL),
hit AS (SELECT o.page_id, o.url, o.fetched_at, h.domain, h.category, row_number() OVER (PARTITION BY o.page_id, o.url, o.fetched_at ORDER BY length(h.domain) DESC, h.domain DESC, h.category DESC) AS k
  FROM one o JOIN held h ON h.action = 'add' AND (o.host = h.domain OR ends_with(o.host, '.' || h.domain)) AND o.fetched_at >= h.since AND (h.until IS NULL OR o.fetched_at < h.until))
SELECT o.page_id, o.url, CAST(o.fetched_at AS VARCHAR) AS fetched_at, o.host, o.n_captures, hit.domain IS NOT NULL AS blocked, hit.domain AS matched_domain, hit.category
FROM one o LEFT JOIN hit ON hit.page_id = o.page_id AND hit.url = o.url AND hit.fetched_at = o.fetched_at AND hit.k = 1"""
