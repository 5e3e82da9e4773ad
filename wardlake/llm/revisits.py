"""Not-modified captures resolved to the response they stand for.

A revisit record says that a page had not changed. It is joined as of its time with the latest earlier full response of
the same canonical url. If their validators agree (entity tag, modification time, payload digest: each that both
carry, at least one), the response's headers are taken over and those a not-modified answer may update are replaced.

The join is a running last value inside slices of time and a carried value between slices. Slices are cut at quantiles
of the time over all captures, so a url that very many captures share is spread over all of them; what is carried is
one row for each url and slice. Only headers travel; payloads stay with the response id.

A revisit without url, time or earlier response has the outcome ``no_response``. Times that are equal are not earlier;
of responses at one time the largest id counts. Header names compare without case, the last of equal names counts, null
headers are none. Rows of equal id stay apart; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers that a not-modified answer may update.
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEADERS = "map<string,string>"


def canonical_url(url: Column) -> Column:
    """Without scheme, leading ``www.``, fragment, tracking parameters and closing slash; the host in lower case."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[^:/?#]*://", ""), r"(?s)#.*$", "")
    host = F.regexp_replace(F.translate(F.regexp_extract(rest, r"^[^/?]*", 0), _UPPER, _LOWER), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.split(F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1), "&")
    asked = F.filter(asked, lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|ref)(=|$)"))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise(""))


def plain_headers(headers: Column) -> Column:
    """Names in lower case, the last of equal names."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast(HEADERS))),
        lambda e: F.struct(F.translate(e["key"], _UPPER, _LOWER).alias("key"), e["value"].alias("value")),
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda x: x["key"] == e["key"]),
    )
    return F.map_from_entries(last)


def agreement(revisit: Column, response: Column) -> Column:
    """matched, changed, or unverified if they share no validator."""
    bare = lambda tag: F.regexp_replace(tag, r"^W/", "")
    pairs = [
        (bare(revisit["headers"]["etag"]), bare(response["headers"]["etag"])),
        (revisit["headers"]["last-modified"], response["headers"]["last-modified"]),
        (revisit["digest"], response["digest"]),
    ]
    differs, agrees = F.lit(False), F.lit(False)
    for ours, theirs in pairs:
        differs = differs | F.coalesce(ours != theirs, F.lit(False))
        agrees = agrees | F.coalesce(ours == theirs, F.lit(False))
    return F.when(differs, "changed").when(agrees, "matched").otherwise("unverified")


def resolve_revisits(captures: DataFrame, slices: int | None = None) -> DataFrame:
    """Each revisit of ``captures`` (record_id, url, captured_at, kind, headers, digest) with its response.

    ``kind`` is ``response`` or ``revisit``; other kinds are left aside. Gives record_id, canonical_url, captured_at,
    response_id, response_at, outcome and the merged headers (null unless matched).
    """
    slices = slices or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = captures.where(F.col("kind").isin("response", "revisit")).select(
        "record_id",
        canonical_url(F.col("url")).alias("key"),
        F.col("captured_at").cast("bigint").alias("at"),
        (F.col("kind") == "response").alias("full"),
        F.struct(
            plain_headers(F.col("headers")).alias("headers"),
            F.col("digest").alias("digest"),
            F.col("record_id").alias("id"),
            F.col("captured_at").cast("bigint").alias("at"),
        ).alias("info"),
    )
    usable = F.col("key").isNotNull() & F.col("at").isNotNull()
    shares = [k / slices for k in range(1, slices)] or [1.0]
    bounds = named.where(usable).select(F.percentile_approx("at", shares, 10_000)).first()[0] or []
    at = F.col("at")
    cuts = F.array(*[F.lit(b).cast("bigint") for b in sorted(set(bounds))]) if bounds else F.array().cast("array<bigint>")
    placed = named.where(usable).withColumn("slice", F.size(F.filter(cuts, lambda b: b <= at)))

    earlier = Window.partitionBy("key", "slice").orderBy("at", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    response = F.when(F.col("full"), F.col("info"))
    near = placed.withColumn("near", F.last(response, ignorenulls=True).over(earlier)).where(~F.col("full"))
    latest = placed.groupBy("key", "slice").agg(
        F.max_by(response, F.when(F.col("full"), F.struct("at", "record_id"))).alias("latest")
    )
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("key", "slice", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    found = near.join(carried, ["key", "slice"], "left").withColumn("response", F.coalesce("near", "carried"))
    lost = named.where(~usable & ~F.col("full"))
    rows = found.select("record_id", "key", "at", "info", "response").unionByName(
        lost.select("record_id", "key", "at", "info"), allowMissingColumns=True
    )
    outcome = F.when(F.col("response").isNull(), "no_response").otherwise(agreement(F.col("info"), F.col("response")))
    allowed = F.map_filter("info.headers", lambda k, v: k.isin(*UPDATABLE) & v.isNotNull())
    kept = F.map_filter("response.headers", lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return rows.withColumn("outcome", outcome).select(
        "record_id",
        F.col("key").alias("canonical_url"),
        F.col("at").alias("captured_at"),
        F.col("response.id").alias("response_id"),
        F.col("response.at").alias("response_at"),
        "outcome",
        F.when(F.col("outcome") == "matched", F.map_concat(kept, allowed)).alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl derived from ``pages``: a full response of each page, and three not-modified captures around it.

    Some revisits come before the response, some carry another tag, and some have no validator at all.
    """
    page = F.col("page_id")
    tag = F.md5(F.coalesce("html", F.lit("")))
    full = pages.select(
        (page * 10).alias("record_id"),
        "url",
        (page * 100).alias("captured_at"),
        F.lit("response").alias("kind"),
        F.create_map(
            F.lit("ETag"), F.concat(F.lit('"'), tag, F.lit('"')),
            F.lit("Last-Modified"), F.concat(F.lit("day "), (page % 28).cast("string")),
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Date"), (page * 100).cast("string"),
        ).alias("headers"),
        tag.alias("digest"),
    )
    again = pages.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    k = F.col("k")
    when = page * 100 + k * 250 - F.when(page % 11 == 0, 900).otherwise(0)
    headers = F.create_map(
        F.lit("etag"), F.when(page % 5 != 0, F.when((page + k) % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit('W/"'), tag, F.lit('"')))),
        F.lit("last-modified"), F.when(page % 3 == 0, F.concat(F.lit("day "), (page % 28).cast("string"))),
        F.lit("cache-control"), F.concat(F.lit("max-age="), k.cast("string")),
        F.lit("date"), when.cast("string"),
        F.lit("content-length"), F.lit("0"),
    )
    revisit = again.select(
        (page * 10 + k).alias("record_id"),
        F.concat(F.col("url"), F.when(k == 2, F.lit("#again")).otherwise("")).alias("url"),
        when.alias("captured_at"),
        F.lit("revisit").alias("kind"),
        F.map_filter(headers, lambda _, v: v.isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return full.unionByName(revisit)


def headers_text(headers: Column) -> Column:
    entries = F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(entries), ";")


# Bare SQL of the query over ``pages``.
SQL = r"""
WITH cap AS (
  SELECT page_id * 10 AS id, url, page_id * 100 AS t, true AS full_, page_id AS p, 0 AS k, md5(coalesce(html, '')) AS h FROM pages
  UNION ALL
  SELECT page_id * 10 + k, url || CASE WHEN k = 2 THEN '#again' ELSE '' END,
         page_id * 100 + k * 250 - CASE WHEN page_id % 11 = 0 THEN 900 ELSE 0 END, false, page_id, k, md5(coalesce(html, ''))
  FROM pages, (VALUES (1), (2), (3)) AS v(k)),
rest AS (SELECT *, regexp_replace(regexp_replace(url, '^[^:/?#]*://', ''), '(?s)#.*$', '') AS r FROM cap),
named AS (
  SELECT *, regexp_replace(lower(regexp_extract(r, '^[^/?]*', 0)), '^www\.', '')
         || regexp_replace(regexp_extract(r, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
         list_filter(string_split(regexp_extract(r, '(?s)^[^?]*\?(.*)$', 1), '&'),
                     lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)')) AS q
  FROM rest),
keyed AS (SELECT *, base || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS u FROM named),
rev AS (
  SELECT *, CASE WHEN p % 5 <> 0 THEN CASE WHEN (p + k) % 7 = 0 THEN '"other"' ELSE '"' || h || '"' END END AS tag,
         CASE WHEN p % 3 = 0 THEN 'day ' || (p % 28) END AS day
  FROM keyed WHERE NOT full_),
hit AS (
  SELECT rev.*, res.id AS rid, res.t AS rt, '"' || res.h || '"' AS rtag, 'day ' || (res.p % 28) AS rday,
         row_number() OVER (PARTITION BY rev.id ORDER BY res.t DESC, res.id DESC) AS n
  FROM rev LEFT JOIN keyed AS res ON res.full_ AND res.u = rev.u AND res.t < rev.t),
judged AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'no_response'
    WHEN coalesce(tag <> rtag, false) OR coalesce(day <> rday, false) THEN 'changed'
    WHEN coalesce(tag = rtag, false) OR coalesce(day = rday, false) THEN 'matched' ELSE 'unverified' END AS outcome
  FROM hit WHERE n = 1)
SELECT id AS record_id, u AS canonical_url, t AS captured_at, rid AS response_id, rt AS response_at, outcome,
  CASE WHEN outcome = 'matched' THEN 'cache-control=max-age=' || k || ';content-type=text/html;date=' || t || ';etag='
    || CASE WHEN tag IS NULL THEN rtag ELSE 'W/' || tag END || ';last-modified=' || coalesce(day, rday) END AS headers
FROM judged
"""
