"""WARC revisits: as-of resolution to the latest earlier full response (operator 4).

Records are parsed from their text: the WARC header block, the HTTP header block and the payload.  A
not-modified revisit is matched, by canonical URL, with the latest full response before it, in time and
then record order.  Its validators must agree with that response: entity tags by weak comparison if it
has one, else modification dates.  A resolved revisit takes over the payload, and its header fields
update the stored ones, except the fields that describe a message's framing or its connection.

The as-of join never puts one URL into one task: time is cut at quantiles, the latest response inside a
(URL, slice) comes from a window there, and the slices' last responses, one row each, are carried over.

Defined cases: records that are missing, without a target or a date, or without an HTTP block are
returned as ``malformed``; a missing URL is not matched; two records of one time follow their ids; equal
rows give equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.plans.ordered import assign_buckets, null_safe_join, quantile_edges

# fixed values: header fields that a not-modified answer must not replace
FRAMING = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
# fixed values: query parameters that name a visit, not a page
TRACKING = "(utm_[a-z]+|ref|fbclid|gclid|sessionid)"
CRLF = "\r\n"
FIELDS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Scheme, a leading www or m host, default port, fragment, tracking parameters and a last slash go; the host is lower case."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^(www|m)\.", "")
    host = F.regexp_replace(host, ":(80|443)$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^?]*", 0), "/+$", "")
    pairs = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(pairs, lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)")))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(host, path, query)


def fields(block: Column) -> Column:
    """Header lines after the first one as (lower-case name, value), in order; lines without a colon go."""
    lines = F.filter(F.split(block, CRLF), lambda line, i: (i > 0) & (F.locate(":", line) > 1))
    return F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.trim(F.substring(line, F.locate(":", line) + 1, F.length(line))).alias("value"),
        ),
    )


def field(listed: Column, name: str) -> Column:
    """The first value of a header field, or NULL."""
    return F.get(F.filter(listed, lambda f: f["name"] == name), 0)["value"]


def parse(records: DataFrame) -> DataFrame:
    """(record_id, type, url, time, status, headers, payload, sound) from (record_id, record)."""
    gap = CRLF + CRLF
    head = F.substring_index("record", gap, 1)
    rest = F.substring(F.col("record"), F.length(head) + len(gap) + 1, F.length("record"))
    staged = records.select("record_id", F.coalesce("record", F.lit("")).alias("record")).select("record_id", head.alias("head"), rest.alias("rest"))
    http = F.substring_index("rest", gap, 1)
    payload = F.substring(F.col("rest"), F.length(http) + len(gap) + 1, F.length("rest"))
    staged = staged.select("record_id", fields(F.col("head")).alias("warc"), http.alias("http"), payload.alias("payload"))
    return staged.select(
        "record_id",
        F.lower(field(F.col("warc"), "warc-type")).alias("type"),
        field(F.col("warc"), "warc-target-uri").alias("url"),
        F.try_to_timestamp(field(F.col("warc"), "warc-date")).alias("time"),
        F.regexp_extract("http", r"^HTTP/[0-9.]+ ([0-9]{3})", 1).try_cast("int").alias("status"),
        fields(F.col("http")).alias("headers"),
        "payload",
    ).withColumn("sound", F.col("url").isNotNull() & F.col("time").isNotNull() & F.col("status").isNotNull() & F.col("type").isin("response", "revisit"))


def latest_before(rows: DataFrame, key: str, time: str, tie: str, value: str, out: str) -> DataFrame:
    """Adds the last non-missing ``value`` of earlier rows of the same key, by time and tie."""
    staged = rows.withColumn("_t", F.unix_micros(time).cast("double"))
    staged = assign_buckets(staged, "_t", quantile_edges(staged, "_t"), "_slice")
    inside = W.partitionBy(key, "_slice").orderBy("_t", tie).rowsBetween(W.unboundedPreceding, -1)
    local = staged.withColumn(out, F.last(value, ignorenulls=True).over(inside))
    last = F.max_by(value, F.struct("_t", tie))
    ends = staged.filter(F.col(value).isNotNull()).groupBy(key, "_slice").agg(last.alias("_end"))
    slices = staged.select(key, "_slice").distinct()
    across = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = null_safe_join(slices, ends, [key, "_slice"], "left").withColumn("_carried", F.last("_end", ignorenulls=True).over(across))
    joined = null_safe_join(local, carried.drop("_end"), [key, "_slice"])
    return joined.withColumn(out, F.coalesce(out, "_carried")).drop("_t", "_slice", "_carried")


def merged(stored: Column, update: Column) -> Column:
    """Stored fields, with the permitted fields of the update in place of their namesakes, by name."""
    new = F.filter(update, lambda f: ~f["name"].isin(FRAMING))
    names = F.transform(new, lambda f: f["name"])
    return F.array_sort(F.concat(F.filter(stored, lambda f: ~F.array_contains(names, f["name"])), new))


def weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, canonical_url, outcome, source_id, status, payload_md5, headers) of every record.

    Outcomes: full, resolved, mismatch, unvalidated, orphan (no earlier full response), malformed.
    """
    parsed = parse(records).withColumn("canonical_url", canonical_url(F.col("url")))
    full = F.col("sound") & (F.col("type") == "response") & (F.col("status") == 200)
    revisit = F.col("sound") & ~full
    digest = F.md5(F.col("payload").cast("binary"))
    own = F.struct(F.col("record_id").alias("source_id"), F.col("headers"), digest.alias("payload_md5"))
    rows = parsed.withColumn("_full", F.when(full, own)).withColumn("_revisit", revisit)
    rows = rows.select("record_id", "canonical_url", "time", "sound", "status", "headers", "_full", "_revisit")
    # only sound records take part in the join, so a missing URL or time meets no other
    sound, rest = rows.filter("sound"), rows.filter("not sound").withColumn("_found", F.lit(None).cast(rows.schema["_full"].dataType))
    placed = latest_before(sound, "canonical_url", "time", "record_id", "_full", "_found").select(*rest.columns).unionByName(rest)
    stored = F.col("_found.headers")
    etag, old_etag = field(F.col("headers"), "etag"), field(stored, "etag")
    dated, old_dated = field(F.col("headers"), "last-modified"), field(stored, "last-modified")
    agrees = F.when(etag.isNotNull() & old_etag.isNotNull(), weak(etag) == weak(old_etag)).when(
        dated.isNotNull() & old_dated.isNotNull(), dated == old_dated
    )
    outcome = (
        F.when(~F.col("sound"), "malformed")
        .when(~F.col("_revisit"), "full")
        .when(F.col("_found").isNull(), "orphan")
        .when(agrees.isNull(), "unvalidated")
        .when(agrees, "resolved")
        .otherwise("mismatch")
    )
    done = placed.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    listed = F.when(good, merged(stored, F.col("headers"))).otherwise(F.array_sort("headers"))
    return done.select(
        "record_id",
        "canonical_url",
        "outcome",
        F.when(good, F.col("_found.source_id")).alias("source_id"),
        F.when(good, 200).otherwise(F.col("status")).cast("int").alias("status"),
        F.coalesce(F.col("_full.payload_md5"), F.when(good, F.col("_found.payload_md5"))).alias("payload_md5"),
        F.array_join(F.transform(listed, lambda f: F.concat(f["name"], F.lit(": "), f["value"])), "\n").alias("headers"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """(record_id, record): two records per page, as a crawler would have written them.

    Each page is a full response at a time given by its id, and a later visit that was answered with
    304.  The visit falls up to 100,000 seconds later, so other captures of the page may lie between, and
    then the tag it carries is out of date; each eighth visit carries a date instead of a tag, and each
    sixteenth nothing.
    """
    number = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.lit('"'))
    stamp = lambda seconds: F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    taken = F.lit(1_700_000_000) + number * 10
    visited = taken + 5 + F.pmod(number * 7919, F.lit(100_000))
    dated = F.concat(F.lit("Last-Modified: "), stamp(taken - 3600), F.lit(CRLF))
    head = lambda kind, seconds: F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Target-URI: "), F.col("url"), F.lit(f"{CRLF}WARC-Date: "), stamp(seconds), F.lit(CRLF + CRLF)
    )
    response = F.concat(
        head("response", taken),
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html{CRLF}Cache-Control: max-age=60{CRLF}ETag: "), tag, F.lit(CRLF), dated,
        F.lit("Content-Length: "), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit(CRLF + CRLF), F.coalesce("html", F.lit("")),
    )
    validator = F.when(number % 16 == 0, "").when(number % 8 == 0, dated).otherwise(F.concat(F.lit("ETag: W/"), tag, F.lit(CRLF)))
    again = F.concat(
        head("revisit", visited),
        F.lit(f"HTTP/1.1 304 Not Modified{CRLF}Content-Length: 0{CRLF}Cache-Control: max-age="),
        F.pmod(number, F.lit(600)).cast("string"), F.lit(CRLF), validator, F.lit("Date: "), stamp(visited), F.lit(CRLF + CRLF),
    )
    pair = F.array(F.struct((number * 2).alias("record_id"), response.alias("record")), F.struct((number * 2 + 1).alias("record_id"), again.alias("record")))
    return pages.select(F.inline(pair))


ORACLE_SQL = r"""
WITH base AS (
  SELECT page_id, md5(coalesce(html, '')) AS m, octet_length(encode(coalesce(html, ''))) AS size,
    1700000000 + page_id * 10 AS taken, 1700000005 + page_id * 10 + (page_id * 7919) % 100000 AS visited,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages WHERE url IS NOT NULL AND page_id IS NOT NULL
), parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^(www|m)\.', ''), ':(80|443)$', '') AS host,
    regexp_extract(bare, '^[^/?]*(.*)$', 1) AS rest FROM base
), urls AS (
  SELECT *, host || regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS kept FROM parts
), named AS (
  SELECT *, place || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical_url FROM urls
), seen AS (
  SELECT page_id * 2 AS record_id, taken AS t, true AS is_full, * FROM named
  UNION ALL SELECT page_id * 2 + 1, visited, false, * FROM named
), matched AS (
  SELECT *, last_value(CASE WHEN is_full THEN page_id END IGNORE NULLS) OVER w AS src_page FROM seen
  WINDOW w AS (PARTITION BY canonical_url ORDER BY t, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT a.*, b.m AS old_m, b.taken AS old_taken, b.size AS old_size, CASE WHEN a.is_full THEN 'full' WHEN a.src_page IS NULL THEN 'orphan'
    WHEN a.page_id % 16 = 0 THEN 'unvalidated' WHEN a.page_id % 8 = 0 THEN CASE WHEN a.taken = b.taken THEN 'resolved' ELSE 'mismatch' END
    WHEN a.m = b.m THEN 'resolved' ELSE 'mismatch' END AS outcome
  FROM matched a LEFT JOIN named b ON b.page_id = a.src_page
), shown AS (
  SELECT *, strftime(make_timestamp(taken * 1000000 - 3600000000), '%Y-%m-%dT%H:%M:%SZ') AS modified,
    strftime(make_timestamp(old_taken * 1000000 - 3600000000), '%Y-%m-%dT%H:%M:%SZ') AS old_modified,
    strftime(make_timestamp(visited * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS again FROM judged
)
SELECT CAST(record_id AS BIGINT) AS record_id, canonical_url, outcome, CASE WHEN outcome = 'resolved' THEN CAST(src_page * 2 AS BIGINT) END AS source_id,
  CAST(CASE WHEN outcome IN ('full', 'resolved') THEN 200 ELSE 304 END AS INTEGER) AS status,
  CASE WHEN is_full THEN m WHEN outcome = 'resolved' THEN old_m END AS payload_md5,
  CASE WHEN is_full THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10)
    || 'etag: "' || m || '"' || chr(10) || 'last-modified: ' || modified
  WHEN outcome = 'resolved' THEN 'cache-control: max-age=' || page_id % 600 || chr(10) || 'content-length: ' || old_size || chr(10)
    || 'content-type: text/html' || chr(10) || 'date: ' || again || chr(10)
    || 'etag: ' || CASE WHEN page_id % 8 = 0 THEN '"' ELSE 'W/"' END || old_m || '"' || chr(10) || 'last-modified: ' || old_modified
  ELSE 'cache-control: max-age=' || page_id % 600 || chr(10) || 'content-length: 0' || chr(10) || 'date: ' || again
    || CASE WHEN page_id % 16 = 0 THEN '' WHEN page_id % 8 = 0 THEN chr(10) || 'last-modified: ' || modified ELSE chr(10) || 'etag: W/"' || m || '"' END
  END AS headers
FROM shown
"""
