"""Main text of pages and derived archive records."""

import base64
import hashlib
import html
import random
import re

import pytest

from termtide.llm import html_region, markup, warc
from termtide.llm.queries import QUERIES


def test_articles_are_found_whole(spark, sf):
    got = {r.page_id: r for r in QUERIES["op9_maximum_region_html"](spark, sf).collect()}
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", page.html, re.S)[1]).replace("<br>", " ")
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        text = "\n\n".join(b for b in blocks if b)
        assert got[page.page_id].text == text and got[page.page_id].n_chars == len(text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><p>Site name and motto</p></header>
<nav><ul><li><a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this site, do you agree?</p></div>
<main><h1>A&nbsp;title &amp; more</h1><p>First <i>para</i>graph with   many words &eacute;t&#233;.<p>Second one, <br>unclosed, &lt;b&gt; too
<form><input> <p>Subscribe to our letter now</p></form><div class="advert box"><p>Buy this thing now, it is cheap and good</p></div>
<script>var x = "<p>no</p>";</script><blockquote>A quote of some words here.</blockquote>
<section id="comments"><p>I am a reader and I say this and that and more of it.</p></section></main>
<aside><p>Other things that you may like to read</p></aside><footer><p>Imprint and contact</p></footer></body></html>"""


def test_other_templates():
    text = html_region.extract(PAGE, {}, 1.0, -1.0)
    assert text == "A title & more\n\nFirst paragraph with many words été.\n\nSecond one, unclosed, <b> too\n\nA quote of some words here."


def test_lists_links_and_tables_in_articles_stay_whole(spark, sf):
    weights = html_region.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    first, items, last = " ".join(["some"] * 300), [f"item {i} of list" for i in range(40)], " ".join(["other"] * 200)
    parts = ["Head", first, *items, last, "a b", "c d", "Names", "See here."]
    nav = "<nav><ul>" + "<li><a href=/x>Menu entry</a></li>" * 10 + "</ul></nav><div class='ad'>Buy this</div>"
    inner = f"<h1>Head</h1><div><p>{first}</p></div><ul>{''.join(f'<li>{i}</li>' for i in items)}</ul><p>{last}</p><table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table><ul><li>Names</li></ul><p>See <a href=/y>here</a>.</p>"
    for name in ("article", "main"):
        page = f"<html><body>{nav}<{name}>{inner}</{name}><footer><a href=/z>Imprint</a></footer></body></html>"
        assert html_region.extract(page, weights, weights["word"], weights["tag"]) == "\n\n".join(parts)
    # without marked content, too, links and the like cost nothing
    page = f"<html><body>{nav}<p>{first}</p><p>See <a href=/y>here</a>.</p></body></html>"
    assert html_region.extract(page, weights, weights["word"], weights["tag"]) == f"{first}\n\nSee here."


def test_names_are_whole_tokens_and_spare_what_holds_the_article():
    article = "<p>Words of the article that stay.</p><p>And more of them here.</p>"
    text = "Words of the article that stay.\n\nAnd more of them here."
    for names in ("site-content has-sidebar", "layout no-sidebar", "content-with-sidebar", "post comments-open", "entry no-comments", "sidebar-left-layout"):
        for inner in (article, f"<article>{article}</article>"):
            assert html_region.extract(f"<html><body><div class='{names}'>{inner}</div></body></html>", {}, 1.0, -1.0) == text
            assert html_region.extract(f"<html><body><div id='{names.split()[-1]}'>{inner}</div></body></html>", {}, 1.0, -1.0) == text
    for names in ("sidebar", "widget box", "social modal", "related-posts"):
        for name in ("article", "main"):
            page = f"<html><body><div class='{names}'><{name}>{article}<div class='{names}'>Not this one</div></{name}><div class='{names}'>Nor this one</div></div></body></html>"
            assert text in html_region.extract(page, {}, 1.0, -1.0) and "Not this" not in html_region.extract(page, {}, 1.0, -1.0)
    for names in ("sidebar", "left sidebar", "cookie-notice", "comment-list", "site-footer", "ad-1", "share-buttons"):
        page = f"<html><body><div class='{names}'>Not this one</div><article>{article}</article><div id='{names.split()[-1]}'>Nor this one</div></body></html>"
        assert html_region.extract(page, {}, 1.0, -1.0) == text
    comments = f"<main>{article}<div class='comments'><article><p>A reader says so.</p></article></div></main>"
    assert html_region.extract(comments, {}, 1.0, -1.0) == text


MUST_GO = "comments-area comment-section user-comments reader-comments discussion ad-container ad-slot advert-unit sidebar-wrapper related-content promo-block newsletter-block commentList adSlot_3".split()


def test_named_containers_go_and_headings_stay(spark, sf):
    learnt = html_region.learn(spark.read.parquet(f"{sf}/pages.parquet"))
    heads = "<h2 id='cookies'>Cookies</h2><p>Text on cookies for all to read.</p><h2 id='related' class='related'>Related work</h2><p>Others have written on it.</p><h3 id='comments'>Comments</h3><p>On the comments of the court.</p>"
    sections = "<section id='discussion'><h2>Discussion</h2><p>What it all means in the end.</p></section><section id='related-work'><p>More of related work here.</p></section>"
    text = "Cookies\n\nText on cookies for all to read.\n\nRelated work\n\nOthers have written on it.\n\nComments\n\nOn the comments of the court."
    more = "Discussion\n\nWhat it all means in the end.\n\nMore of related work here."
    for weights in ({"word": 1.0, "tag": -1.0}, learnt):
        run = lambda html: html_region.extract(html, weights, weights["word"], weights["tag"])
        assert run(f"<body><article>{heads}{sections}</article></body>") == f"{text}\n\n{more}"
        for name in MUST_GO:
            block = f"<div class='{name}'><p>Not a word of this block is the article's own.</p></div>"
            assert run(f"<body>{block}<article>{heads}{block}{sections}</article>{block}</body>") == f"{text}\n\n{more}", name
            assert run(f"<body>{block}<main>{heads}{block}{sections}</main><section class='{name}'>And nor is this one</section></body>") == f"{text}\n\n{more}", name
        assert run("<body><article><p>One two three.</p><p class='ad'>Buy now</p><ul><li>four</li><li class='cookie-notice'>No</li></ul></article></body>") == "One two three.\n\nfour"
    # pages without an article element, by constant weights
    body = "<p>" + "Some words of the page. " * 8 + "</p>"
    want = ("Some words of the page. " * 8).strip()
    for name in MUST_GO:
        block = f"<div class='{name}'><p>Not a word of this.</p></div>"
        assert html_region.extract(f"<body><div class='post'>{body}{block}{body}</div>{block}</body>", {}, 1.0, -1.0) == f"{want}\n\n{want}", name


def test_names_are_learnt(spark):
    """A container whose name the list has not, but which labelled pages have outside of their article only."""
    rows = [(i, f"<body><div class='teaser-row'><p>words of a teaser {i} of some length</p></div><article><p>the article {i} has words</p></article><div class='teaser-row'><p>more of them</p></div></body>") for i in range(20)]
    weights = html_region.learn(spark.createDataFrame(rows, "page_id long, html string"))
    assert weights["named teaser"] < 0.1 and weights["named row"] < 0.1
    page = "<body><div class='teaser-row'><p>some other teaser with quite a lot of words in it</p></div><div class='text'><p>what the page is about</p></div></body>"
    assert html_region.extract(page, weights, 1.0, -1.0) == "what the page is about"


def test_odd_pages(spark):
    rows = [(1, None, "a"), (1, "", "b"), (2, "<div><p></p></div>", None), (3, "no markup at all", "c"), (3, "no markup at all", "c"), (None, "<p>" + "long words " * 20_000, "d"), (4, "<p>a < b <c", "e")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = html_region.main_text(df, html_region.learn(df))
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    got = [r.text for r in out.collect()]
    assert got[:5] == ["", "", "", "no markup at all", "no markup at all"] and len(got[5]) == 219_999 and got[6].startswith("a < b")
    assert html_region.main_text(df.limit(0), {"word": 1.0, "tag": -1.0}).collect() == []


def test_records_link_and_digest(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    source = warc.responses(pages, "2026-01-01T00:00:00Z")
    sources = {r.record_id: r for r in source.collect()}
    records = QUERIES["op7_warc_derivatives"](spark, sf).collect()
    by_id = {r.record_id: r for r in records}
    assert len(by_id) == len(records) == 2 * pages.count() and len(sources) == pages.count()
    for r in records:
        own, data = sources[r.refers_to], r.block.encode()
        assert (r.target_uri, r.date, r.payload_digest) == (own.target_uri, own.date, own.payload_digest)
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode() and r.content_length == len(data)
        assert by_id[r.concurrent_to].refers_to == r.refers_to and by_id[r.concurrent_to].warc_type != r.warc_type
        assert r.headers == "Content-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(own.block.split("\r\n\r\n", 1)[1].encode()))
        if r.warc_type == "metadata":
            assert f"source-payload-digest: {own.payload_digest}\r\n" in r.block and "source-status: 200\r\n" in r.block
        else:
            assert r.block == markup.plain_text(own.block.split("\r\n\r\n", 1)[1])[1]


def test_files_round_trip(spark, sf, tmp_path):
    source = warc.responses(spark.read.parquet(f"{sf}/pages.parquet"), "2026-01-01T00:00:00Z")
    every = source.unionByName(warc.derive(source))
    warc.records_to_text(every).write.option("lineSep", "\r\n\r\n").text(str(tmp_path / "w"))
    back = warc.read_records(spark, str(tmp_path / "w"))
    assert back.columns == warc.RECORD.names
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, every.collect()), key=str)


def one_by_one(data):
    """Records of a file's bytes by reading on from each to the next."""
    at, out = data.find(b"WARC/1.0\r\n"), []
    while 0 <= at < len(data):
        top = data.index(b"\r\n\r\n", at)
        size = int(re.search(rb"Content-Length: (\d+)", data[at:top])[1])
        out.append((re.search(rb"WARC-Record-ID: (\S+)", data[at:top])[1].decode(), data[top + 4 : top + 4 + size].decode()))
        at = top + 4 + size + 4
    return out


@pytest.mark.parametrize("split", ["300", "100000000"])
def test_blocks_that_hold_record_starts(spark, tmp_path, split):
    rng = random.Random(8)
    start = "WARC/1.0\r\n"
    inside = [start, f"text {start}more", "é漢\r\n\r\n", f"{start}WARC-Record-ID: <no>\r\nContent-Length: 40\r\n\r\n", f"{start}Content-Length: 5000\r\n\r\nx", f"{start}Content-Length: 99999999\r\n\r\n", "plain " * 30, "\r\n\r\n", ""]
    for name in "ab":
        blocks = ["".join(rng.choice(inside) for _ in range(rng.randrange(5))) for _ in range(80)]
        records = [f"{start}WARC-Type: resource\r\nWARC-Record-ID: <{name}{i}>\r\nContent-Length: {len(b.encode())}\r\n\r\n{b}\r\n\r\n" for i, b in enumerate(blocks)]
        (tmp_path / name).write_text(("junk\r\n" if name == "b" else "") + "".join(records), newline="")
    (tmp_path / "empty").write_text("")
    expected = [r for name in "ab" for r in one_by_one((tmp_path / name).read_bytes())]
    assert len(expected) == 160
    before = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for n, value in zip(before, (split, "0")):
            spark.conf.set(n, value)
        got = [(r.record_id, r.block) for r in warc.read_records(spark, str(tmp_path)).collect()]
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert sorted(got) == sorted(expected)


def test_records_without_a_usable_length(spark, tmp_path):
    start = "WARC/1.0\r\n"
    (tmp_path / "f").write_text(f"{start}WARC-Record-ID: <1>\r\n\r\none\r\n\r\n{start}WARC-Record-ID: <2>\r\ncontent-length: 900\r\n\r\ntwo\r\n\r\n{start}WARC-Record-ID: <3>\r\nContent-Length: x\r\n\r\n\r\n\r\n{start}WARC-Record-ID: <4>", newline="")
    got = {r.record_id: (r.block, r.content_length) for r in warc.read_records(spark, str(tmp_path)).collect()}
    assert got == {"<1>": ("one", None), "<2>": ("two", 900), "<3>": ("", None), "<4>": ("", None)}


def test_odd_records(spark):
    rows = [("response", "<urn:a>", None, None, None, None, None), ("response", "<urn:b>", "u", "d", None, None, "HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\n\r\n<p>gone"), ("request", "<urn:c>", "u", "d", None, None, "GET /"),
            ("response", "<urn:d>", "u", "d", None, None, "HTTP/1.0 200 OK\r\ncontent-TYPE: Text/HTML; charset=x\r\n\r\n<title>a<b></title><p>one<p>two")]
    df = spark.createDataFrame(rows, "warc_type string, record_id string, target_uri string, date string, block_digest string, payload_digest string, block string")
    got = [(r.warc_type, r.refers_to, r.block if r.warc_type == "conversion" else None) for r in warc.derive(df).collect()]
    assert sorted(got, key=str) == sorted([("metadata", "<urn:a>", None), ("metadata", "<urn:b>", None), ("metadata", "<urn:d>", None), ("conversion", "<urn:d>", "one\ntwo")], key=str)
    assert warc.derive(df.limit(0)).collect() == []
