"""Operator 5, not-modified revisit resolution.

A revisit record stands for a "304 Not Modified" answer and has no payload. It is resolved by an as-of join: the latest full
response of the same canonical URL that is strictly earlier (of equal times, the one of the largest record_id). The
validators must agree: the entity tag, compared weakly, if the revisit has one, else the modification time, else there is
nothing to check and the revisit stays unverified. The stored headers are then updated with those of the revisit, but for the headers
that describe a connection or a payload.

The as-of join is in two levels, so that one URL with very many records doesn't meet in one task: within chunks of time a
window finds the latest earlier response; across chunks only the last response of each chunk is carried on.

Outcome: resolved, unverified, validator_mismatch, no_earlier_response, and full for records that are responses themselves.

Cases: null or unparsable URLs and null times match nothing; null validators are absent ones; a null header map is empty; of
header names that differ in case only, the least one's value counts;
repeated rows are each resolved; equal times are no earlier; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers of a 304 answer that don't replace stored ones (RFC 9111, 3.2, and what describes the payload).
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that don't change what is served.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
_URL = r"^(?i:https?)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without index page and trailing slash, sorted query without tracking parameters; no scheme, user or fragment. Null if it isn't http or https."""
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, _URL, 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, _URL, 2), r"/index\.html?$", "/"), r"/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(url, _URL, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.array_join(params, "&")
    return F.when(url.rlike(_URL) & (host != ""), F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def strong(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def resolve(records: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """records: record_id, url, ts long, is_revisit boolean, etag, last_modified string, headers map<string,string>, payload_digest string.

    Returns record_id, url_key, ts, refers_to (record_id of the response), outcome, headers (merged) and payload_digest (of what the record stands for). chunk: units of ts within which records of a URL are brought together."""
    r = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", F.coalesce("is_revisit", F.lit(False)).alias("is_revisit"), "etag", "last_modified", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload_digest").withColumn("chunk", F.floor(F.col("ts") / chunk))
    response = F.struct("ts", "record_id", "etag", "last_modified", "payload_digest", F.map_entries("headers").alias("headers"))
    full = ~F.col("is_revisit") & F.col("ts").isNotNull()
    known = r.where("url_key is not null and ts is not null")
    within = Window.partitionBy("url_key", "chunk").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = known.withColumn("found", F.max(F.when(full, response)).over(within))
    last = known.where(full).groupBy("url_key", "chunk").agg(F.max(response).alias("last"))
    # a chunk's record looks at the chunks before its own: the last response of each chunk is carried to the chunks that hold revisits
    places = last.select("url_key", "chunk", "last").unionByName(known.where("is_revisit").select("url_key", "chunk").distinct(), allowMissingColumns=True)
    places = places.groupBy("url_key", "chunk").agg(F.max("last").alias("last"))
    carried = places.select("url_key", "chunk", F.max("last").over(Window.partitionBy("url_key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    joined = inside.join(carried, ["url_key", "chunk"], "left").withColumn("found", F.coalesce("found", "carried")).drop("carried")
    rest = r.where("url_key is null or ts is null").withColumn("found", F.lit(None).cast(joined.schema["found"].dataType))
    return joined.unionByName(rest).select("record_id", "url_key", "ts", *_resolved())


def lower_names(entries: Column) -> Column:
    """A map of headers with names in lower case from an array of entries. Of names that differ in case only, the least one's value stays."""
    low = F.transform(F.array_sort(entries), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(low, lambda e: e["key"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.get(F.filter(low, lambda e: e["key"] == n), F.lit(0))["value"]))


def _resolved() -> list[Column]:
    found = F.col("found")
    same_tag = strong(F.col("etag")) == strong(found["etag"])
    outcome = (
        F.when(~F.col("is_revisit"), "full")
        .when(found.isNull(), "no_earlier_response")
        .when(F.col("etag").isNotNull(), F.when(F.coalesce(same_tag, F.lit(False)), "resolved").otherwise("validator_mismatch"))
        .when(F.col("last_modified").isNotNull(), F.when(F.coalesce(F.col("last_modified") == found["last_modified"], F.lit(False)), "resolved").otherwise("validator_mismatch"))
        .otherwise("unverified")
    )
    named = lower_names(F.map_entries("headers"))
    news = F.map_filter(named, lambda k, _: ~k.isin(*NOT_MERGED))
    stored = lower_names(found["headers"])
    kept = F.map_filter(stored, lambda k, _: ~F.map_contains_key(news, k))
    good = F.col("is_revisit") & outcome.isin("resolved", "unverified")
    return [
        F.when(good, found["record_id"]).alias("refers_to"),
        outcome.alias("outcome"),
        F.when(good, F.map_concat(kept, news)).otherwise(named).alias("headers"),
        F.when(good, found["payload_digest"]).when(~F.col("is_revisit"), F.col("payload_digest")).alias("payload_digest"),
    ]


def headers_text(headers: Column) -> Column:
    """name: value lines in order of name."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))), "\n")


def page_records(pages: DataFrame) -> DataFrame:
    """The crawl that the pages table stands for: every page is a full response at 10 * page_id, and is asked for again 5 later with the entity tag
    of what was served. The length of the page decides what the second answer has: a multiple of 7, a tag that has changed; of
    11, no tag but the modification time; of 5, it came 5 before the page rather than after it."""
    size = F.length("html")
    day = F.concat(F.lit("2024-01-"), F.lpad((F.pmod(F.col("page_id"), F.lit(28)) + 1).cast("string"), 2, "0"))
    digest = F.md5(F.col("html").cast("binary"))
    base = pages.select(F.col("page_id").cast("long"), "url", size.alias("size"), day.alias("day"), digest.alias("digest"))
    answer = F.explode(F.array(F.lit(False), F.lit(True))).alias("is_revisit")
    tag = F.concat(F.lit('"'), F.col("digest"), F.lit('"'))
    again = F.col("is_revisit")
    return base.select("*", answer).select(
        (2 * F.col("page_id") + again.cast("long")).alias("record_id"),
        "url",
        (10 * F.col("page_id") + F.when(~again, 0).when(F.col("size") % 5 == 0, -5).otherwise(5)).cast("long").alias("ts"),
        "is_revisit",
        F.when(~again, tag).when(F.col("size") % 7 == 0, F.lit('"changed"')).when(F.col("size") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
        F.when(~again | (F.col("size") % 11 == 0), F.col("day")).alias("last_modified"),
        F.when(~again, F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size").cast("string"), F.lit("Date"), F.col("day")))
        .otherwise(F.create_map(F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Date"), F.concat(F.lit("later than "), F.col("day")))).alias("headers"),
        F.when(~again, F.col("digest")).alias("payload_digest"),
    )
