import hashlib
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from sluice.llm import warc
from sluice.llm.common import shared_path
from sluice.llm.url_filters import RULES, declared_targets, url_verdicts

PAGES = "page_id long, url string, html string, node string, own string, payload string"


def make_pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def test_rules_and_aliases(spark):
    canonical = '<html><head><link href="{}" rel=canonical></head></html>'
    refresh = "<meta http-equiv='Refresh' content='0; URL=\"{}\"'>"
    rows = [
        (1, "http://a.net/es/x", None),
        (2, "https://www.a.org/1", canonical.format("http://a.net/es/x")),
        (3, "https://m.a.org/1?utm_source=x#top", ""),
        (4, "http://b.org/2", refresh.format("http://A.org/1/")),
        (5, "http://c.org/", canonical.format("/other")),
        (6, "http://c.org/other?q=1", None),
        (7, "http://d.com/", canonical.format("http://e.net/fr/1")),
        (8, "http://e.net/fr/1", None),
        (9, "http://f.org/", canonical.format("//e.net/fr/1")),
        (10, "no scheme", None),
        (11, None, None),
        (12, "http://X.Example.COM/en/a", None),
        (13, "http://www.example.com/en/a", None),
        (14, "http://example.com", None),
        (15, "http://notexample.com/en/a", None),
        (16, "http://e.net?x=/fr/", None),
        (1, "http://a.net/es/x", None),
        (None, "http://a.org/1?ref=mail&utm_x", None),
    ]
    found = [tuple(r) for r in url_verdicts(make_pages(spark, rows)).collect()]
    by_id = {r[0]: r[1:] for r in found}
    assert len(found) == len(rows)
    assert by_id[1] == ("a.net", "/es/x", "net/es/", "block")
    assert by_id[2] == ("www.a.org", "/1", None, "block")
    assert by_id[3] == ("m.a.org", "/1", None, "block")
    assert by_id[4] == ("b.org", "/2", None, "block")
    assert by_id[None] == ("a.org", "/1", None, "block")
    assert by_id[5][3] == by_id[6][3] == "allow"
    assert by_id[7] == ("d.com", "/", "com/", "allow")
    assert by_id[8][2:] == ("net/fr/", "block")
    assert by_id[9][2:] == (None, "allow")  # an alias is allowed by a rule
    assert by_id[10] == by_id[11] == ("", "", None, "allow")
    assert by_id[12][2:] == ("example.com/en/", "block")
    assert by_id[13][2:] == ("www.example.com/en/", "allow")
    assert by_id[14] == ("example.com", "", None, "allow")
    assert by_id[15][2:] == ("com/", "allow")
    assert by_id[16] == ("e.net", "", None, "allow")


BASE = "http://site.org/a/b/page.html?old=1#top"
REFERENCES = [
    *("x.html", "../x.html", "./x", "../../../x", ".", "..", "./", "c/../d/./e?p=../q#f", "?id=1"),
    *("/go?to=http://x.net/es/", "/a/./b/../c", "//other.net/es/1", "http://other.net/es/2", "#part"),
    *("x?u=http://y.net/es/", "mailto:a@b.c", "javascript:void(0)", "x.html?a=1&amp;b=2", "ftp://f.net/es/"),
]


def test_references_are_resolved(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [(k, BASE, link.format(ref)) for k, ref in enumerate(REFERENCES)]
    rows += [(100, "http://site.org", link.format("x"))]
    rows = make_pages(spark, rows).select("page_id", declared_targets(F.col("url"), F.col("html")).alias("t"))
    found = {r.page_id: r.t for r in rows.collect()}
    for k, ref in enumerate(REFERENCES):
        to = urljoin(BASE, ref.replace("&amp;", "&"))
        to = BASE.split("#")[0] + ref if ref.startswith("#") else to
        assert found[k] == ([] if ":" in ref.split("/")[0] and "://" not in ref else [to]), ref
    assert found[100] == ["http://site.org/x"]


def test_blocks_reach_aliases_by_any_reference(spark):
    refresh = "<meta http-equiv=refresh content='0; url={}'>"
    rows = [
        (1, "http://a.net/es/x/1", None),
        (2, "http://www.a.net/go/page", refresh.format("../es/x/1")),
        (3, "http://b.net/es/p", None),
        (4, "http://b.net/other/", "<link rel='canonical nofollow' href='/es/p'>"),
        (5, "http://c.org/", refresh.format("/go?to=http://b.net/es/p")),
        (6, "http://m.a.net/es2/q?id=7", None),
        (7, "http://a.net/es2/q", refresh.format("?id=7")),
    ]
    found = {r.page_id: r.verdict for r in url_verdicts(make_pages(spark, rows)).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow"}


def test_base_of_references(spark):
    """Against <base href>, with white space around references and letters written as references."""
    rows = [
        (1, BASE, '<base href="/c/"><link rel=canonical href="x.html">'),
        (2, BASE, '<base target=_top><base href="http://a.net/es/1"><link rel=canonical href="2">'),
        (3, BASE, "<link rel=canonical href='\n\t http://a.net/es/3 \r\n'>"),
        (4, BASE, '<link rel=canonical href="http&colon;&#47;&#x2F;a.net/es?x=1&#38;y=2&amp;amp;">'),
        (5, BASE, '<link rel=canonical href="y"><base href="">'),
    ]
    rows = make_pages(spark, rows).select(
        "page_id", declared_targets(F.col("url"), F.col("html")).alias("t")
    )
    assert {r.page_id: r.t for r in rows.collect()} == {
        1: ["http://site.org/c/x.html"],
        2: ["http://a.net/es/2"],
        3: ["http://a.net/es/3"],
        4: ["http://a.net/es?x=1&y=2&amp;"],
        5: ["http://site.org/a/b/y"],
    }


def test_base_carries_a_block(spark):
    rows = [
        (1, "http://a.net/es/x", None),
        (2, "http://b.org/", '<base href="http://a.net/es/"><link rel=canonical href="x">'),
    ]
    found = {r.page_id: r.verdict for r in url_verdicts(make_pages(spark, rows)).collect()}
    assert found == {1: "block", 2: "block"}


def test_rules_from_a_table(spark, sf_dir):
    """The joined rules give the answers of the nested ones, ties and odd rows included."""
    more = [
        *RULES,
        ("block", "b/xy"),
        ("allow", "a.b/"),
        ("block", "example.com/en/a/b"),
        ("allow", "org/a%b"),
        ("block", "a.b.c.d/"),
    ]
    hosts = ["a.b", "b", "x.a.b", "example.com", "www.example.com", "x.org", "a.b.c.d", "d", "e.net"]
    paths = ["", "/", "/xy", "/en/", "/en/a/b", "/en/a/bc", "/a%b", "/es/1", "/fr/", "?q=/xy"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    rows = [(k, u, None) for k, u in enumerate([*urls, *urls[:5], None, "no address", "http://"])]
    table = spark.createDataFrame(more, "verdict string, rule string")
    pages = make_pages(spark, rows)
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(url_verdicts(pages, table)) == order(url_verdicts(pages, more))
    given = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.createDataFrame(list(RULES), "verdict string, rule string")
    assert order(url_verdicts(given, rules)) == order(url_verdicts(given))


def test_redirect_table(spark):
    pages = make_pages(spark, [(1, "http://q.org/a", None), (2, "http://z.net/es/", None)])
    hops = [("http://q.org/a", "http://h.org/1"), ("http://h.org/1", "http://z.net/es")]
    hops = spark.createDataFrame([*hops, (None, "http://q.org/a")], "src string, dst string")
    found = {r.page_id: r.verdict for r in url_verdicts(pages, redirects=hops).collect()}
    assert found == {1: "block", 2: "block"}


def test_no_pages(spark):
    none = make_pages(spark, [])
    assert url_verdicts(none).count() == 0
    assert warc.archive_report(none).count() == 0


def expected_report(rows):
    data = [(r[0], (r[2] or "").encode()) for r in rows]
    winner = {}
    for page_id, payload in data:
        if len(payload) >= 1000 and page_id is not None:
            winner[payload] = max(page_id, winner.get(payload, page_id))
    found = []
    for page_id, payload in data:
        best = winner.get(payload)
        kind = "response" if best is None or best == page_id else "revisit"
        refers = best if kind == "revisit" else None
        digest = hashlib.sha1(payload).hexdigest()
        found.append((page_id, len(payload), digest, kind, refers, None))
    return sorted(found, key=str)


@pytest.mark.parametrize("segment", [97, 8192])
def test_archives(spark, segment):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n0\r\n\r\n" * 40
    rows = [
        (1, "http://a/", "x" * 1000),
        (2, "http://b/\r\nEvil: 1", "x" * 1000),
        (3, None, "x" * 999),
        (4, "http://c/", "x" * 999),
        (5, "http://d/", None),
        (6, "http://e/", ""),
        (7, "http://f/", tricky),
        (8, "http://g/", "ü€😀" * 30_000),
        (9, "http://h/", "\r\n" * 5000),
        (9, "http://h/", "\r\n" * 5000),
        (10, "http://i/", "\r\n" * 5000),
        (10, "http://i/", "\r\n" * 5000),
        (None, "http://j/", tricky),
        (None, "http://k/", "y" * 2000),
    ]
    report = warc.archive_report(make_pages(spark, rows), segment_bytes=segment, rows_per_file=3)
    found = [tuple(r) for r in report.collect()]
    assert sorted(found, key=str) == expected_report(rows)


def test_reading_other_archives(spark):
    """Segments in any order; missing ones and wrong lengths are reported."""
    block = warc.HTTP_HEAD + b"5;x=y\r\nhello\r\n6\r\n world\r\n0\r\nTrailer: 1\r\n\r\n"
    cut = [block[:40], block[40:60], block[60:]]

    def record(kind, own, part, number=None, origin=None, total=None):
        fields = {"WARC-Type": kind, "WARC-Record-ID": own, "WARC-Segment-Number": number}
        fields |= {"WARC-Segment-Origin-ID": origin, "WARC-Segment-Total-Length": total}
        return warc._record(fields, part).decode()

    rows = [
        record("warcinfo", "<i>", b"software: x\r\n"),
        record("continuation", "<a3>", cut[2], 3, "<a>", len(block)),
        record("response", "<a>", cut[0], 1),
        record("continuation", "<a2>", cut[1], 2, "<a>"),
        record("response", "<b>", cut[0], 1),
        record("continuation", "<b3>", cut[2], 3, "<b>", len(block)),
        record("response", "<c>", cut[0], 1),
        record("continuation", "<c2>", block[40:], 2, "<c>", len(block) + 1),
        record("response", "<d>", cut[0], 1),
        record("response", "<e>", warc.HTTP_HEAD + b"9\r\nshort\r\n0\r\n\r\n"),
        record("response", "<f>", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"),
    ]
    path = shared_path(spark, "test-archives")
    df = spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)
    df.write.option("lineSep", warc.SEPARATOR).option("compression", "gzip").text(path)
    found = {r.record_id: (r.payload and bytes(r.payload), r.error) for r in warc.read_payloads(spark, path).collect()}
    assert found == {
        "<a>": (b"hello world", None),
        "<b>": (None, "a segment is missing"),
        "<c>": (None, "the total length is wrong"),
        "<d>": (None, "the last segment is missing"),
        "<e>": (None, "a chunk is shorter than its size"),
        "<f>": (b"abc", None),
    }


def test_long_payload_of_many_segments(spark):
    """Parts are joined once: 24 MB in 400 000 segments, within a generous time."""
    import time

    html = "".join(f"<p>{k}</p>" for k in range(2_000_000))
    pages = make_pages(spark, [(1, "http://a.b/", html), (2, "http://a.b/2", "<p>")])
    begin = time.time()
    found = {r.page_id: r for r in warc.archive_report(pages, segment_bytes=64).collect()}
    assert found[1].payload_digest == hashlib.sha1(html.encode()).hexdigest()
    assert found[1].payload_bytes == len(html) and found[1].error is None
    assert time.time() - begin < 120
