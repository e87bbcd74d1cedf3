"""URL filters whose lists change over time.

List entries are dated events, ``add`` or ``remove`` of a domain under a
category. A domain's events become intervals during which it is listed, and
every capture is judged by the entries that were active when it was fetched: its
host and all parent domains are looked up as of that time.

Captures of one host at one time are judged once, so a host's captures are not
gathered in one task. Intervals and captures meet on the domain and a slot of
``SLOT_DAYS`` days, so a domain with a long history or many captures is spread over slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOT_DAYS = 30
HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null where the URL has none."""
    host = F.regexp_extract(F.lower(F.trim(url)), HOST, 1)
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def parents(host: Column) -> Column:
    """The host and every domain above it."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def slot(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / SLOT_DAYS).cast("int")


def intervals(events: DataFrame) -> DataFrame:
    """(domain, category, listed, until) from (domain, category, day, action); ``until`` is null while the entry stands.

    Events without domain or day are left out. Of several events of a domain
    and category on one day, an addition counts.
    """
    days = (events.filter("domain is not null and day is not null")
            .groupBy(F.lower("domain").alias("domain"), F.coalesce("category", F.lit("")).alias("category"), "day")
            .agg(F.max((F.col("action") == "add").cast("int")).alias("_add")))
    history = W.partitionBy("domain", "category").orderBy("day")
    return (days.withColumn("until", F.lead("day").over(history)).filter("_add = 1")
            .select("domain", "category", F.col("day").alias("listed"), "until"))


def judge(captures: DataFrame, events: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """All columns of ``captures`` and host, blocked, matched_domain, category, listed.

    Of several active entries the most specific domain is reported, then the
    first category. A capture without a host or fetch day matches nothing. Repeated
    captures are judged alike. Input columns of the added names are replaced.
    """
    added = ("host", "blocked", "matched_domain", "category", "listed")
    rows = captures.withColumns({"_host": host_of(F.col(url_col)), "_day": F.col(time_col).cast("date")})
    asked = rows.filter("_host is not null and _day is not null").select("_host", "_day").distinct()
    lookups = asked.select("_host", "_day", slot(F.col("_day")).alias("_slot"), F.explode(parents(F.col("_host"))).alias("domain"))
    end = captures.agg(F.max(F.col(time_col).cast("date")).alias("d")).first()["d"]
    known = intervals(events)
    if end is None:
        known, end_col = known.limit(0), F.lit(None).cast("date")
    else:
        end_col = F.lit(end)
    last = F.coalesce(F.date_sub("until", 1), end_col)
    spans = (known.withColumn("_last", last).filter(F.col("_last") >= F.col("listed"))
             .withColumn("_slot", F.explode(F.sequence(slot(F.col("listed")), slot(F.col("_last"))))).drop("_last"))
    met = lookups.join(spans, ["domain", "_slot"]).filter((F.col("listed") <= F.col("_day")) & (F.col("until").isNull() | (F.col("_day") < F.col("until"))))
    best = met.groupBy("_host", "_day").agg(F.min(F.struct((-F.length("domain")).alias("n"), "domain", "category", "listed")).alias("_best"))
    return (rows.join(best, ["_host", "_day"], "left")
            .select(*[c for c in captures.columns if c not in added], F.col("_host").alias("host"), F.col("_best").isNotNull().alias("blocked"),
                    F.col("_best.domain").alias("matched_domain"), F.col("_best.category").alias("category"), F.col("_best.listed").alias("listed")))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day of two years, from the page's number: the test pages have none."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int")).alias("fetched"))


def host_events(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts: about a third are added, most of those removed, some added again."""
    hosts = pages.select(F.regexp_replace(host_of(F.col("url")), r"^(www|blog|m)\.", "").alias("domain")).filter("domain is not null").distinct()
    h = hosts.withColumn("_h", F.md5(F.col("domain").cast("binary")))
    def number(at: int) -> Column:
        return F.conv(F.substring("_h", at, 3), 16, 10).cast("int")
    listed = h.filter((F.substring("_h", 1, 1) < "6") | F.rlike("domain", F.lit("spam|pills")))
    first = F.date_add(F.lit("2022-09-01").cast("date"), F.pmod(number(2), F.lit(600)))
    gone = F.date_add(first, 20 + F.pmod(number(5), F.lit(300)))
    again = F.date_add(gone, 10 + F.pmod(number(8), F.lit(200)))
    category = F.when(F.substring("_h", 11, 1) < "8", "spam").otherwise("adult")
    rows = [F.struct(first.alias("day"), F.lit("add").alias("action")),
            F.struct(F.when(F.substring("_h", 12, 1) < "c", gone).alias("day"), F.lit("remove").alias("action")),
            F.struct(F.when(F.substring("_h", 13, 1) < "6", again).alias("day"), F.lit("add").alias("action"))]
    return listed.select("domain", category.alias("category"), F.inline(F.array(*rows)))


ORACLE = r"""
WITH c AS (SELECT page_id, url, CAST(DATE '2023-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS DATE) fetched,
    nullif(regexp_replace(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '\.$', ''), '') host FROM pages),
h AS (SELECT domain, md5(domain) h FROM (SELECT DISTINCT regexp_replace(host, '^(www|blog|m)\.', '') domain FROM c WHERE host IS NOT NULL)),
n AS (SELECT *, CAST(DATE '2022-09-01' + CAST(('0x' || substr(h, 2, 3))::INT % 600 AS INTEGER) AS DATE) one, 20 + ('0x' || substr(h, 5, 3))::INT % 300 d2,
    10 + ('0x' || substr(h, 8, 3))::INT % 200 d3, CASE WHEN substr(h, 11, 1) < '8' THEN 'spam' ELSE 'adult' END category
    FROM h WHERE substr(h, 1, 1) < '6' OR regexp_matches(domain, 'spam|pills')),
e AS (SELECT domain, category, one AS day, 1 AS add_ FROM n
    UNION ALL SELECT domain, category, CAST(one + d2 AS DATE), 0 FROM n WHERE substr(h, 12, 1) < 'c'
    UNION ALL SELECT domain, category, CAST(one + d2 + d3 AS DATE), 1 FROM n WHERE substr(h, 13, 1) < '6'),
i AS (SELECT domain, category, day AS listed, lead(day) OVER (PARTITION BY domain, category ORDER BY day) until, add_ FROM e),
m AS (SELECT c.page_id, i.domain, i.category, i.listed, row_number() OVER (PARTITION BY c.page_id ORDER BY length(i.domain) DESC, i.domain, i.category) rn
    FROM c JOIN i ON add_ = 1 AND (c.host = i.domain OR ends_with(c.host, '.' || i.domain)) AND listed <= fetched AND (until IS NULL OR fetched < until))
SELECT c.page_id, c.url, CAST(c.fetched AS VARCHAR) fetched, c.host, m.domain IS NOT NULL AS blocked, m.domain AS matched_domain, m.category,
    CAST(m.listed AS VARCHAR) listed
FROM c LEFT JOIN m ON c.page_id = m.page_id AND rn = 1
"""
