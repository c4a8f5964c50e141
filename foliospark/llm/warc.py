"""Not-modified revisit records and the full responses they stand for.

A revisit refers to the latest full response of the same canonical URL that is strictly earlier. Its validators are checked
against that response: the ETag if the revisit has one (compared weakly), else Last-Modified. A match takes the
payload of the response and its headers, updated by those a 304 may change.

Each revisit gets one row and an outcome: ``etag`` or ``last_modified`` (matched), ``changed`` (the validator differs), ``unverified`` (no validator),
``no_response`` (nothing earlier, or no URL). Only matches get a payload and merged headers. Of responses at the same time the greatest record
id counts. A null time makes a revisit ``no_response`` and a response invisible. Repeated rows are resolved each. Payloads
are known by digest and size only, so their length does not matter. An empty table gives no rows. Added columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import keeps_columns

# The fields that a 304 may update (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")
# Query parameters that do not select content.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$"
URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
SPANS = 64

RECORD = "record_id bigint, url string, kind string, ts bigint, headers array<struct<name:string,value:string>>, payload_sha256 string, payload_bytes bigint"


def canonical_url(url: Column) -> Column:
    """Host without ``www``, user and default port; path without closing slash; sorted parameters without tracking; no scheme or fragment."""
    part = lambda i: F.regexp_extract(F.trim(url), URL, i)
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(part(2)), "^.*@", ""), ":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(part(3), "/+$", "")
    parameters = F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.array_join(parameters, "&")
    return F.when(F.trim(url) != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def header(headers: Column, name: str) -> Column:
    """The first value of a field, or null."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored fields, with the permitted fields of the update in place of theirs; sorted by name and value."""
    allowed = F.filter(update, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    kept = F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"])))
    return F.array_sort(F.transform(F.concat(kept, allowed), lambda h: F.struct(F.lower(h["name"]).alias("name"), h["value"].alias("value"))))


def latest_earlier(records: DataFrame, spans: int = SPANS) -> DataFrame:
    """As-of join: each revisit with ``_found``, the latest earlier full response of its canonical URL.

    The times of a URL are cut into spans, and what each span hands on is its latest response; so a
    URL with a large share of all rows is worked on in as many tasks as it has spans, and a window over spans holds at most ``spans`` rows per URL.
    """
    full = F.when(F.col("kind") == "response", F.struct("ts", "record_id", "headers", "payload_sha256", "payload_bytes"))
    low, high = records.agg(F.min("ts"), F.max("ts")).first()
    width = max(1, ((high or 0) - (low or 0)) // spans + 1)
    placed = records.where(F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()).select(
        "*", full.alias("_full"), F.floor((F.col("ts") - F.lit(low or 0)) / F.lit(width)).alias("_span"))
    last = placed.groupBy("canonical_url", "_span").agg(F.max("_full").alias("_last"))
    earlier = Window.partitionBy("canonical_url").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("canonical_url", "_span", F.max("_last").over(earlier).alias("_full")).where(F.col("_full").isNotNull())
    rows = placed.select("*", F.lit(False).alias("_carried")).unionByName(
        carried.select("canonical_url", "_span", "_full", F.col("_full.ts").alias("ts"), F.lit(True).alias("_carried")), allowMissingColumns=True)
    before = Window.partitionBy("canonical_url", "_span").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("_found", F.max("_full").over(before)).where(~F.col("_carried") & (F.col("kind") == "revisit"))
    lost = records.where((F.col("kind") == "revisit") & (F.col("canonical_url").isNull() | F.col("ts").isNull()))
    return found.drop("_full", "_span", "_carried").unionByName(lost, allowMissingColumns=True)


@keeps_columns
def resolve_revisits(records: DataFrame, spans: int = SPANS) -> DataFrame:
    """One row per revisit record: outcome, the response it refers to, payload and merged headers. Further columns stay."""
    records = records.drop("outcome", "refers_to").withColumn("canonical_url", canonical_url(F.col("url")))
    asof = latest_earlier(records, spans)
    etag, modified = header(F.col("headers"), "etag"), header(F.col("headers"), "last-modified")
    weak = lambda c: F.regexp_replace(F.trim(c), "^W/", "")
    stored_etag, stored_modified = header(F.col("_found.headers"), "etag"), header(F.col("_found.headers"), "last-modified")
    outcome = (F.when(F.col("_found").isNull(), "no_response")
               .when(etag.isNotNull(), F.when(weak(etag) == weak(stored_etag), "etag").otherwise("changed"))
               .when(modified.isNotNull(), F.when(modified == stored_modified, "last_modified").otherwise("changed"))
               .otherwise("unverified"))
    out = asof.withColumn("outcome", outcome)
    match = F.col("outcome").isin("etag", "last_modified")
    return out.withColumns({
        "refers_to": F.col("_found.record_id"),
        "payload_sha256": F.when(match, F.col("_found.payload_sha256")),
        "payload_bytes": F.when(match, F.col("_found.payload_bytes")),
        "headers": F.when(match, merged_headers(F.col("_found.headers"), F.coalesce("headers", F.array().cast("array<struct<name:string,value:string>>")))),
    }).drop("_found")


def crawl_records(pages: DataFrame) -> DataFrame:
    """Capture records of a crawl that visits every page of a ``pages`` table again: a full response each, a revisit an hour later under the other
    scheme, and for every fourth page a revisit before the response. Every fifth page changed its ETag meanwhile; every seventh revisit has no validator.
    """
    page, html = F.col("page_id"), F.coalesce(F.col("html"), F.lit(""))
    etag = F.concat(F.lit('"'), F.substring(F.sha2(html, 256), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), (page % 50).cast("string"))
    field = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    response = F.array(field("Content-Type", F.lit("text/html")), field("ETag", etag), field("Last-Modified", modified), field("Cache-Control", F.lit("max-age=60")),
                       field("Content-Length", F.octet_length(html).cast("string")))
    current = F.when(page % 5 == 0, F.concat(F.lit('"changed-'), page.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit("W/"), etag))
    later = F.when(page % 7 == 0, F.array(field("Cache-Control", F.lit("max-age=600")))).otherwise(
        F.array(field("etag", current), field("Cache-Control", F.lit("max-age=600")), field("Content-Type", F.lit("text/plain"))))
    early = F.array(field("Last-Modified", modified), field("Expires", F.lit("0")))
    other = F.concat(F.when(F.col("url").startswith("https:"), F.regexp_replace("url", "^https:", "http:")).otherwise(F.regexp_replace("url", "^http:", "https:")), F.lit("#again"))
    record = lambda n, url, kind, ts, headers, digest, size: F.struct(
        (page * 3 + n).alias("record_id"), url.alias("url"), F.lit(kind).alias("kind"), ts.cast("bigint").alias("ts"), headers.alias("headers"),
        digest.alias("payload_sha256"), size.cast("bigint").alias("payload_bytes"))
    none = F.lit(None).cast("string")
    visits = F.array(
        record(0, F.col("url"), "response", page * 10, response, F.sha2(html, 256), F.octet_length(html)),
        record(1, other, "revisit", page * 10 + 3600, later, none, F.lit(None)),
        F.when(page % 4 == 0, record(2, F.col("url"), "revisit", page * 10 - 1, early, none, F.lit(None))))
    return pages.select(F.explode(F.filter(visits, lambda v: v.isNotNull())).alias("_v")).select("_v.*")
