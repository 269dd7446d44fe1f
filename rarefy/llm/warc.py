"""Revisit records of a web archive, resolved to the capture they refer to.

A revisit (server not modified) has headers and no body. It is resolved by
an as-of join: the latest full response of the same canonical URL that was
captured earlier. Where the validators agree, the stored headers are
updated with the permitted headers of the revisit.

A URL may hold a large part of all captures, so no window covers a whole
URL: captures are cut into ``slots`` time slots, the last response of each
(URL, slot) is aggregated, carried on over the slots (at most ``slots``
rows a URL), and the window over captures runs within one slot.

Validators. Entity tags are compared weakly (without ``W/``); without one
in the revisit, Last-Modified is compared; without either the revisit is
``unvalidated``. Status is ``resolved``, ``mismatch``, ``unvalidated`` or
``no_target``; only ``resolved`` rows get merged headers.

Defined results: a record without URL or time is no target and resolves to
none; a response at the same time as the revisit isn't earlier; of
responses at one time the largest record_id counts; repeated revisits give
repeated rows; null headers count as none; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

# Fields of a not-modified response that don't replace stored ones
# (framing and content of the stored body, and fields of one connection).
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer",
              "transfer-encoding", "upgrade")
#: parameters that name a visit, not a document
TRACKING = "^(utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid|jsessionid)(=.*)?$"


def canonical(url: Column) -> Column:
    """Canonical form: no scheme, user, www., default port or fragment; host lower-cased;
    no slash at the path's end; tracking parameters dropped, the others sorted."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "^[^?]*[?](.*)$", 1)
    args = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda a: (a != "") & ~F.lower(a).rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(args != "", F.concat(F.lit("?"), args)).otherwise(F.lit("")))


def _lower_keys(headers: Column) -> Column:
    """Names lower-cased; of names that differ in case only, the last one counts."""
    entries = F.map_entries(headers)
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def merged(stored: Column, fresh: Column) -> Column:
    """Stored headers with the permitted ones of a not-modified response put in place."""
    allowed = F.map_filter(_lower_keys(fresh), lambda k, _: ~k.isin(*NOT_MERGED))
    kept = F.map_filter(_lower_keys(stored), lambda k, _: ~F.map_contains_key(allowed, k))
    return F.map_concat(kept, allowed)


def with_slots(records: DataFrame, slots: int) -> DataFrame:
    """Adds slot: ``at`` cut at about even row counts (one sketch pass), so that a stray time doesn't
    put the rest into one slot."""
    times = records.select(F.col("at").cast("double").alias("_at")).where("_at IS NOT NULL")
    edges = times.approxQuantile("_at", [i / slots for i in range(1, slots)], 1 / (8 * slots))
    cuts = [-float("inf"), *sorted(set(edges)), float("inf")]
    if len(cuts) < 3:
        return records.withColumn("slot", F.lit(0.0))
    return (Bucketizer(splits=cuts, inputCol="_at", outputCol="slot", handleInvalid="keep")
            .transform(records.withColumn("_at", F.col("at").cast("double"))).drop("_at"))


def resolve_revisits(records: DataFrame, slots: int = 512) -> DataFrame:
    """``records``: record_id, url, at (long), kind ('response' or 'revisit'), etag, last_modified,
    headers (map). One row per revisit: record_id, canonical_url, target_id, status, headers."""
    none = F.create_map().cast("map<string,string>")
    r = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical(F.col("url")).alias("url"), F.col("at").cast("long").alias("at"),
        F.col("kind").alias("kind"), F.regexp_replace("etag", "^W/", "").alias("etag"), F.col("last_modified").alias("last_modified"),
        F.coalesce(F.col("headers"), none).alias("headers"))
    r = with_slots(r, slots)
    full = (F.col("kind") == "response") & F.col("url").isNotNull() & F.col("at").isNotNull()
    capture = F.struct("record_id", "etag", "last_modified", "headers")

    last = r.where(full).groupBy("url", "slot").agg(F.max_by(capture, F.struct("at", "record_id")).alias("capture"))
    # the slots of revisits take part, so that each finds what the slots before it carry on
    slots_of = r.where("kind = 'revisit' AND url IS NOT NULL AND at IS NOT NULL").select("url", "slot").distinct()
    before = Window.partitionBy("url").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.join(slots_of.withColumn("asked", F.lit(True)), ["url", "slot"], "full")
               .withColumn("carried", F.last("capture", ignorenulls=True).over(before)).where("asked").select("url", "slot", "carried"))

    # at one time the revisit comes first, since a response then isn't earlier
    order = Window.partitionBy("url", "slot").orderBy("at", F.when(full, 1).otherwise(0), "record_id")
    own = (r.where(full | (F.col("kind") == "revisit"))
           .withColumn("own", F.last(F.when(full, capture), ignorenulls=True).over(order))
           .where("kind = 'revisit'"))
    out = own.join(carried, ["url", "slot"], "left").withColumn(
        "target", F.when(F.col("url").isNotNull() & F.col("at").isNotNull(), F.coalesce("own", "carried")))
    t = F.col("target")
    status = (F.when(t.isNull(), "no_target")
              .when(F.col("etag").isNotNull(), F.when(F.col("etag") == F.regexp_replace(t["etag"], "^W/", ""), "resolved").otherwise("mismatch"))
              .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == t["last_modified"], "resolved").otherwise("mismatch"))
              .otherwise("unvalidated"))
    return out.select("record_id", F.col("url").alias("canonical_url"), t["record_id"].alias("target_id"), status.alias("status"),
                      F.when(status == "resolved", merged(t["headers"], F.col("headers"))).alias("headers"))


def captures(pages: DataFrame, recheck: int = 86_400, step: int = 60) -> DataFrame:
    """Records of a crawl in the order of page_id, one page each ``step`` seconds: the page's full
    response, and its recheck ``recheck`` seconds later, which the server answers with the validators
    of that page. Another page of the same canonical URL in between makes the recheck a mismatch."""
    at = F.col("page_id") * step
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    size = F.octet_length("html").cast("string")
    stamp = lambda x: F.date_format(F.timestamp_seconds(x), "yyyy-MM-dd HH:mm:ss")
    text = lambda c: F.coalesce(c, F.lit(""))
    response = F.struct(
        (F.col("page_id") * 2).alias("record_id"), F.col("url").alias("url"), at.alias("at"), F.lit("response").alias("kind"), tag.alias("etag"),
        stamp(at).alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"), text(size), F.lit("ETag"), text(tag),
                     F.lit("Date"), text(stamp(at)), F.lit("Cache-Control"), F.lit("max-age=3600")).alias("headers"))
    revisit = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.col("url").alias("url"), (at + recheck).alias("at"), F.lit("revisit").alias("kind"),
        F.concat(F.lit("W/"), tag).alias("etag"), stamp(at).alias("last_modified"),
        F.create_map(F.lit("content-length"), F.lit("0"), F.lit("connection"), F.lit("close"), F.lit("etag"), text(F.concat(F.lit("W/"), tag)),
                     F.lit("date"), text(stamp(at + recheck)), F.lit("expires"), text(stamp(at + 2 * recheck))).alias("headers"))
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def header_text(headers: Column) -> Column:
    """Header lines in the order of their names."""
    lines = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(lines, "\n")


_CANONICAL = r"""
  regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www[.]', '')
  || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '')
  || CASE WHEN args <> '' THEN '?' || args ELSE '' END
"""
ORACLE = rf"""
WITH a AS (SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
b AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'),
             lambda x: x <> '' AND NOT regexp_matches(lower(x), '{TRACKING}'))), '&') AS args FROM a),
c AS (SELECT page_id, {_CANONICAL} AS url, page_id * 60 AS ts, '"' || md5(html) || '"' AS tag, strlen(html) AS size FROM b),
j AS (SELECT r.page_id * 2 + 1 AS record_id, r.url AS canonical_url, t.page_id AS t_id, t.tag = r.tag AS same, r.tag, t.size AS t_size, r.ts + 86400 AS ts
      FROM c r ASOF LEFT JOIN c t ON r.url = t.url AND t.ts < r.ts + 86400)
SELECT record_id, canonical_url, t_id * 2 AS target_id,
       CASE WHEN t_id IS NULL THEN 'no_target' WHEN same THEN 'resolved' ELSE 'mismatch' END AS status,
       CASE WHEN same THEN 'cache-control: max-age=3600' || chr(10) || 'content-length: ' || t_size || chr(10) || 'content-type: text/html; charset=utf-8'
            || chr(10) || 'date: ' || strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S') || chr(10) || 'etag: W/' || tag
            || chr(10) || 'expires: ' || strftime(make_timestamp((ts + 86400) * 1000000), '%Y-%m-%d %H:%M:%S') END AS headers
FROM j
"""
