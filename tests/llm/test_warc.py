"""WARC revisits: parsing, as-of matches against plain Python, merged headers."""

import random

import pytest

from pyspark.sql import functions as F

from mlspark.llm import warc

END = "\r\n"


def record(kind, url, when, status, headers, payload=""):
    head = END.join(["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Target-URI: {url}", f"WARC-Date: {when}"])
    http = END.join([f"HTTP/1.1 {status} x", *headers])
    return head + END * 2 + http + END * 2 + payload


def day(n):
    return f"2024-01-{1 + n // 24:02d}T{n % 24:02d}:00:00Z"


def resolve(spark, rows):
    df = spark.createDataFrame([(i, r, "x") for i, r in rows], "record_id long, record string, headers string")
    return {r["record_id"]: r for r in warc.resolve(df).collect()}


def test_canonical_urls(spark):
    forms = {
        "http://www.Site.com:80/a/": "site.com/a",
        "https://m.site.com/a#top": "site.com/a",
        "HTTPS://site.com:443/a?utm_source=x&b=2&a=1&ref=q": "site.com/a?a=1&b=2",
        "site.com/A?": "site.com/A",
        "https://site.com:8080/?reference=1": "site.com:8080?reference=1",
        None: None,
        "": "",
    }
    df = spark.createDataFrame([(u, v) for u, v in forms.items()], "url string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", warc.canonical_url(df["url"]).alias("got")).collect())


def test_outcomes_and_merged_headers(spark):
    full = ['ETag: "1"', "Content-Length: 5", "Cache-Control: max-age=1", "Set-Cookie: a", "Set-Cookie: b", "no colon"]
    rows = [
        (1, record("response", "http://a.com/x", day(1), 200, full, "hello\r\n\r\nworld")),
        (2, record("revisit", "https://www.a.com/x/", day(2), 304, ['etag: W/"1"', "Content-Length: 0", "Cache-Control: max-age=9", "Connection: close"])),
        (3, record("revisit", "http://a.com/x", day(3), 304, ['ETag: "2"'])),
        (4, record("revisit", "http://a.com/x", day(4), 304, ["Server: s"])),
        (5, record("revisit", "http://a.com/x", day(0), 304, ['ETag: "1"'])),
        (6, record("response", "http://b.com", day(1), 200, ["Last-Modified: yesterday"], "p")),
        (7, record("revisit", "http://b.com/", day(2), 304, ["Last-Modified: yesterday", 'ETag: "z"'])),
        (8, record("response", "http://a.com/x", day(5), 500, [], "broken")),
        (9, None), (10, ""), (11, "WARC/1.1"), (12, record("response", "http://a.com/x", "never", 200, [])),
    ]
    out = resolve(spark, rows)
    assert {i: r["outcome"] for i, r in out.items()} == {
        1: "full", 2: "resolved", 3: "mismatch", 4: "unvalidated", 5: "orphan", 6: "full", 7: "resolved", 8: "unvalidated",
        9: "malformed", 10: "malformed", 11: "malformed", 12: "malformed",
    }
    assert out[2]["source_id"] == 1 and out[2]["status"] == 200 and out[2]["payload_md5"] == out[1]["payload_md5"]
    assert out[2]["headers"].split("\n") == ["cache-control: max-age=9", "content-length: 5", 'etag: W/"1"', "set-cookie: a", "set-cookie: b"]
    assert out[3]["payload_md5"] is None and out[3]["status"] == 304


def test_as_of_join_equals_plain_search(spark):
    rng = random.Random(0)
    rows, plain = [], []
    for i in range(600):
        url = "http://hot.com/" if rng.random() < 0.4 else f"http://s{rng.randrange(40)}.com/{rng.randrange(3)}"
        when, kind, tag = rng.randrange(600), rng.choice(["response", "revisit"]), f'ETag: "{rng.randrange(3)}"'
        rows.append((i, record(kind, url, day(when), 200 if kind == "response" else 304, [tag], str(i))))
        plain.append((url, when, i, kind, tag))
    out = resolve(spark, rows)
    for url, when, i, kind, tag in plain:
        if kind == "response":
            assert out[i]["outcome"] == "full"
            continue
        earlier = [p for p in plain if p[0] == url and p[3] == "response" and p[1:3] < (when, i)]
        best = max(earlier, key=lambda p: p[1:3], default=None)
        want = ("orphan", None) if best is None else ("resolved", best[2]) if best[4] == tag else ("mismatch", None)
        assert (out[i]["outcome"], out[i]["source_id"]) == want


def test_repeated_rows_and_empty_tables(spark):
    one = (1, record("response", "http://a.com", day(1), 200, [], "p"))
    df = spark.createDataFrame([one, one], "record_id long, record string")
    assert [r["outcome"] for r in warc.resolve(df).collect()] == ["full", "full"]
    assert warc.resolve(df.limit(0)).collect() == []
    pages = spark.createDataFrame([(None, "u", "h"), (1, None, "h"), (2, "http://a.com", None)], "page_id long, url string, html string")
    out = {r["record_id"]: r["outcome"] for r in warc.resolve(warc.page_records(pages)).collect()}
    assert out == {None: "malformed", 2: "malformed", 3: "malformed", 4: "full", 5: "resolved"}


def test_no_header_line_is_dropped(spark):
    block = "HTTP/1.1 200 OK\r\n" + "\r\n".join(f"X-{i}: {i}" for i in range(150_000))
    row = spark.createDataFrame([(block,)], "block string").select(warc.fields(F.col("block")).alias("f")).first()["f"]
    assert len(row) == 150_000 and tuple(row[-1]) == ("x-149999", "149999")
