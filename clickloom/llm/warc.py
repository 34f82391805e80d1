"""Resolution of WARC revisit records that a server answered with "not modified".

A revisit stands for the latest earlier full response of the same canonical URL, provided
its validators agree. It is then given that response's payload, and the response's headers
updated by those of its own that such an answer may change.

The as-of join runs on records dealt out by ranges of URL and time, so one URL with a great
share of all records is spread over many tasks. Inside a range the latest response is found
by a window; a URL that goes on in the next range takes the latest response of the ranges
before along. There are at most as many such URLs as ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored

# Query parameters that do not belong to a canonical URL.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
# Headers that a "not modified" answer does not change: those of the
# connection, and those that describe the stored payload.
NOT_UPDATED = (
    "connection",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
)


def canonical_url(url: Column) -> Column:
    """Without scheme, `www.`, default port, tracking parameters, fragment and last slash;
    the host in lower case."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(host, "^www\\.", "")
    host = F.when((scheme == "http") | (scheme == ""), F.regexp_replace(host, ":80$", "")).otherwise(host)
    host = F.when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/$", "")
    query = F.regexp_extract(rest, "\\?(.*)$", 1)
    query = F.regexp_replace(query, f"(^|&)(?i:{TRACKING})=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _headers(headers: Column) -> Column:
    """Names in lower case; of names that then are equal, the last one holds."""
    entries = F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")),
    )
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(
        F.transform(
            names, lambda n: F.struct(n, F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"])
        )
    )


def merged_headers(stored_headers: Column, revisit: Column) -> Column:
    """The stored headers, updated by those of the revisit that it may change."""
    update = F.map_filter(revisit, lambda k, v: ~k.isin(*NOT_UPDATED))
    kept = F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(update, k))
    return F.map_concat(kept, update)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def _agreement(revisit: str, original: str) -> Column:
    """Whether validators agree: by ETag if both have one, else by Last-Modified, else by
    the digest of the payload; null if they share none."""
    own, its = F.col(revisit), F.col(original)
    etags = own["headers"]["etag"].isNotNull() & its["headers"]["etag"].isNotNull()
    dates = own["headers"]["last-modified"].isNotNull() & its["headers"]["last-modified"].isNotNull()
    return (
        F.when(etags, _strong(own["headers"]["etag"]) == _strong(its["headers"]["etag"]))
        .when(dates, own["headers"]["last-modified"] == its["headers"]["last-modified"])
        .otherwise(own["payload_digest"] == its["payload_digest"])
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per record: record_id, kind, canonical_url, ts, status, original_id, headers,
    payload_digest, payload_length.

    `records` has record_id, url, ts, kind (`response` or `revisit`), headers (map),
    payload_digest and payload_length; other columns are not read. Earlier means by time and
    then record id, so ties have an order. Status: `response` for full responses (unchanged);
    `resolved` with the original's id, payload and merged headers; `mismatch` if the
    validators of the latest earlier response differ; `no_validator` if the two share none;
    `no_original`; `unplaced` for a null URL or time, which takes no part, and for a record of
    another kind. Null headers are none. Repeated rows are resolved alike. An empty table
    gives no rows.
    """
    own = F.struct("record_id", "headers", "payload_digest", "payload_length")
    rows = records.select(
        "record_id",
        "kind",
        canonical_url(F.col("url")).alias("canonical_url"),
        "ts",
        _headers(F.col("headers")).alias("headers"),
        "payload_digest",
        F.col("payload_length").cast("long").alias("payload_length"),
    ).withColumn("own", own).drop("headers", "payload_digest", "payload_length")
    placed = F.coalesce(
        F.col("canonical_url").isNotNull() & F.col("ts").isNotNull() & F.col("kind").isin("response", "revisit"), F.lit(False)
    )
    ranged = rows.where(placed).repartitionByRange("canonical_url", "ts", "record_id")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "warc-ranges")
    response = F.when(F.col("kind") == "response", F.col("own"))

    before = Window.partitionBy("part", "canonical_url").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("found", F.last(response, ignorenulls=True).over(before))
    # URLs that lie in more than one range: at most as many as there are ranges
    ends = ranged.groupBy("canonical_url").agg(F.min("part").alias("first"), F.max("part").alias("last"))
    broken = ends.where(F.col("first") < F.col("last")).select("canonical_url")
    latest = ranged.join(broken, "canonical_url").groupBy("canonical_url", "part").agg(
        F.max_by(response, F.when(response.isNotNull(), F.struct("ts", "record_id"))).alias("latest")
    )
    parts_before = Window.partitionBy("canonical_url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("canonical_url", "part", F.last("latest", ignorenulls=True).over(parts_before).alias("carried"))
    joined = local.join(carried, ["canonical_url", "part"], "left")
    joined = joined.withColumn("original", F.coalesce("found", "carried"))

    is_revisit = F.col("kind") == "revisit"
    agreed = _agreement("own", "original")
    status = (
        F.when(~is_revisit, "response")
        .when(F.col("original").isNull(), "no_original")
        .when(agreed.isNull(), "no_validator")
        .when(agreed, "resolved")
        .otherwise("mismatch")
    )
    unplaced = rows.where(~placed).select(
        "*", F.lit(None).cast(joined.schema["original"].dataType).alias("original"), F.lit("unplaced").alias("status")
    )
    judged = joined.withColumn("status", status).select(*unplaced.columns).unionByName(unplaced)
    resolved = F.col("status") == "resolved"
    return judged.select(
        "record_id",
        "kind",
        "canonical_url",
        "ts",
        "status",
        F.when(resolved, F.col("original.record_id")).alias("original_id"),
        F.when(resolved, merged_headers(F.col("original.headers"), F.col("own.headers"))).otherwise(F.col("own.headers")).alias("headers"),
        F.when(resolved, F.col("original.payload_digest")).otherwise(F.col("own.payload_digest")).alias("payload_digest"),
        F.when(resolved, F.col("original.payload_length")).otherwise(F.col("own.payload_length")).alias("payload_length"),
    )


def header_text(headers: str = "headers") -> Column:
    """Headers as lines `name: value`, sorted by name."""
    entries = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl history for pages (page_id, url, html), for the registered query: a response
    for each page, for some a changed one half a day later, and revisits of four kinds: a day
    later under other spellings of the URL, a day before, with a foreign ETag, and with
    Last-Modified alone."""
    page = F.col("page_id")
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    day = 86_400
    begin = F.lit(1_704_067_200) + page * 60
    http_date = F.concat(F.lit("day "), page.cast("string"))
    rest = F.regexp_replace(F.regexp_replace(F.col("url"), "^[a-z]+://", ""), "#.*$", "")
    port = F.when(F.startswith("url", F.lit("https")), ":443").otherwise(":80")
    spelled = F.concat(
        F.upper(F.regexp_extract("url", "^([a-z]+://)", 1)),
        F.upper(F.regexp_extract(rest, "^([^/?]*)", 1)),
        port,
        F.regexp_extract(rest, "^[^/?]*(.*)$", 1),
        F.lit("#again"),
    )

    def record(number: int, kind: str, url: Column, seconds: int, headers: dict[str, Column], digest_: Column, length: Column) -> Column:
        pairs = [x for name, value in headers.items() for x in (F.lit(name), value)]
        return F.struct(
            (page * 8 + number).alias("record_id"),
            url.alias("url"),
            (begin + seconds).alias("ts"),
            F.lit(kind).alias("kind"),
            F.create_map(*pairs).alias("headers"),
            digest_.alias("payload_digest"),
            length.cast("long").alias("payload_length"),
        )

    def etag(text: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(text, 1, 16), F.lit('"'))

    length = F.length(F.coalesce(F.col("html"), F.lit("")))
    changed = F.sha2(F.concat(digest, F.lit("changed")), 256)
    full = {"Content-Type": F.lit("text/html"), "Last-Modified": http_date, "X-Served": F.lit("full")}
    seen = {"Date": http_date, "Cache-Control": F.lit("max-age=60"), "Content-Length": F.lit("0"), "Connection": F.lit("close")}
    nothing, none = F.lit(None).cast("string"), F.lit(None).cast("long")
    records = [
        record(0, "response", F.col("url"), 0, full | {"ETag": etag(digest), "Content-Length": length.cast("string")}, digest, length),
        F.when(page % 11 == 0, record(1, "response", F.col("url"), day // 2, full | {"ETag": etag(changed), "Content-Length": (length + 7).cast("string")}, changed, length + 7)),
        F.when(page % 3 != 2, record(2, "revisit", spelled, day, seen | {"etag": F.concat(F.lit("W/"), etag(digest))}, nothing, none)),
        F.when(page % 5 == 0, record(3, "revisit", F.col("url"), -day, seen | {"ETag": etag(digest)}, nothing, none)),
        F.when(page % 7 == 0, record(4, "revisit", F.col("url"), 2 * day, seen | {"ETag": F.lit('"foreign"')}, nothing, none)),
        F.when(page % 4 == 1, record(5, "revisit", F.col("url"), 3 * day, seen | {"last-modified": http_date}, digest, none)),
    ]
    listed = F.filter(F.array(*records), lambda r: r.isNotNull())
    return pages.select(F.explode(listed).alias("r")).select("r.*")
