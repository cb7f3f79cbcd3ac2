"""Expressions against Python's own notions of the same things."""

import html as html_lib
import re
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from termtide.functions import series, text, web


def column(spark, values, expression, name="c"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {name} string")
    return [r.out for r in df.select("i", expression(F.col(name)).alias("out")).orderBy("i").collect()]


SPACED = ["a  b", " a\t\nb ", "x  y", "　z\x1c", "", None, "a\x85b", "plain"]


def test_clean_equals_python(spark):
    expected = [re.sub(r"\s+", " ", v or "").strip() for v in SPACED]
    assert column(spark, SPACED, text.clean) == expected


def test_normalize_keyword_equals_python(spark):
    values = ["Hamlet's QUIZ!", "  a_b  c ", "Что это?", "½ cup", "éa", "--", "", None, "naïve café"]
    expected = []
    for v in values:
        kw = re.sub(r"[^\w\s]", " ", (v or "").lower().strip())
        expected.append(re.sub(r"\s+", " ", kw).strip())
    assert column(spark, values, text.normalize_keyword) == expected
    assert column(spark, expected, text.normalize_keyword) == expected


def test_unescape_knows_all_names_and_numbers(spark):
    values = ["&Eacute;t&eacute; &ntilde;&times;&rarr;&oacute;", "&copy 2024 &copyx &notit; &notin; &ampx", "&#x0000041; &#65 &#0; &#128; &#xD800; &#99999999; &#1; &#xFFFE;",
              "&NotEqualTilde; &nosuch; &; &# &#x;", "&alpha;&Omega;&infin;&sum;&hearts;&larr;&lang;&nbsp;&frac12;&hellip"]
    assert column(spark, values, text.unescape) == [html_lib.unescape(v) for v in values]


def test_unescape_resolves_each_reference_once(spark):
    values = [
        "a &amp; b", "&lt;p&gt;", "&amp;lt;", "&#39;x&#x27;", "&#8217;", "&unknown; &", "&#38;lt;", "&quot;&copy;&middot;",
        "no references", "&#x1F600;", "R&D", "",
    ]
    assert column(spark, values, text.unescape) == [html_lib.unescape(v) for v in values]


def test_tokens(spark):
    values = ["why so", "...a bcde", "éa_b x", "", "a bb ccc"]
    assert column(spark, values, text.first_token) == ["why", "a", "éa_b", "", "a"]
    assert column(spark, values, text.first_long_token) == ["", "bcde", "éa_b", "", ""]


def test_contains_any_takes_words_literally(spark):
    values = ["a.b", "axb", "free pdf now", "c++"]
    assert column(spark, values, lambda c: text.contains_any(c, ("a.b", "free pdf", "c++"))) == [True, False, True, True]
    assert column(spark, values, lambda c: text.contains_any(c, ())) == [False] * 4


def test_to_number(spark):
    assert column(spark, ["1.5", "HIGH", "NaN", None, "-2"], text.to_number) == [1.5, None, None, None, -2.0]


BASES = [
    "https://h.example/a/b/c?x=1#f", "https://h.example", "https://h.example/", "http://h.example/a/", "https://h.example/d/e.html",
]
HREFS = [
    "x", "./x", "../x", "../../../x", "/p//q/../r", "/p/.", "/p/..", "?q=2", "#z", "", "//h.example/k?l=1#m", "//o.example/k",
    "https://h.example/abs/../kept", "mailto:a@b", "javascript:void(0)", "s/t?u=v#w", ".", "..", "a/b/", " padded ", "x?y=/z/../w",
]


def test_resolve_url_equals_stdlib(spark):
    rows = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string")
    got = df.select("b", "h", web.resolve_url(web.url_parts("b"), F.col("h")).alias("u")).collect()
    for r in got:
        expected = urljoin(r.b, r.h.strip()).split("#")[0]
        assert r.u == expected, (r.b, r.h, r.u, expected)


PAGE = """<!DOCTYPE html><html class="x" lang='en-US'><head><title> A &amp; B </title>
<meta name="viewport" content="w"><META content='Say "hi"' name=description>
<link rel="stylesheet" href="/s.css"><link href="https://c.example/p" rel="canonical"></head>
<body><header><h1>skipped text</h1></header><!-- <h1>no</h1> <a href="/no"> -->
<script>var a='<a href="/js">';</script>
<h1>foo <b>bar</b> </h1><H2 id=1>one</H2><h2> two &lt; </h2>
<nav><a href="/nav">n</a></nav><p>Body <a href="rel?x=1&amp;y=2#f">link</a> 1 < 2
<a class=c href=plain>p</a><a href='https://other.example/'>o</a><a name=x>none</a><footer>foot</footer></body></html>"""


def test_page_parts(spark):
    df = spark.createDataFrame([("https://h.example/d/p?id=7", PAGE)], "url string, html string").withColumn("m", web.markup("html"))
    row = df.select(
        web.page_lang("m").alias("lang"), web.page_title("m").alias("title"), web.page_meta("m").alias("meta"),
        web.canonical_url("url", "m").alias("canonical"), web.page_headings("m", 1).alias("h1"), web.page_headings("m", 2).alias("h2"),
        web.main_text("html").alias("body"), web.internal_links("url", "m").alias("links"),
    ).first()
    assert row.lang == "en-US" and row.title == "A & B" and row.meta == 'Say "hi"' and row.canonical == "https://c.example/p"
    assert row.h1 == "skipped text | foobar" and row.h2 == "one | two <"
    assert row.body == "A & B foo bar one two < Body link 1 < 2 p o none"
    assert row.links == ["https://h.example/d/plain", "https://h.example/d/rel?x=1&y=2", "https://h.example/nav"]


@pytest.mark.parametrize(
    "url, kind, ids",
    [
        ("https://h/contest?id=12", "contest", ("12", "", "")),
        ("https://h/Read?x=1&id=5", "reading", ("", "5", "")),
        ("https://h/thread/9?id=4", "reading", ("", "4", "")),
        ("https://h/chat?id=8", "echo", ("", "", "8")),
        ("https://contest.example/", "home", ("", "", "")),
        ("https://h", "home", ("", "", "")),
        ("https://h/about?id=3", "page", ("", "", "")),
    ],
)
def test_content_type_and_ids(spark, url, kind, ids):
    df = spark.createDataFrame([(url,)], "u string")
    routed = web.page_ids("u")
    row = df.select(web.content_type("u").alias("k"), *[c.alias(n) for n, c in routed.items()]).first()
    assert (row.k, (row.course_id, row.reading_id, row.echo_id)) == (kind, ids)
    assert (urlparse(url).path in ("", "/")) == (kind == "home")


MONTHS = "array<struct<year:int,month:int,search_volume:bigint>>"


def test_series(spark):
    year = [(2024, m, v) for m, v in zip(range(1, 13), [10, 0, None, 40, 5, 6, 7, 8, 20, 10, 11, 30])]
    rows = [(0, year), (1, []), (2, None), (3, [(2024, 1, 5)]), (4, [(None, None, 1), (2024, 2, 9), (2024, 2, 8)]), (5, [(2023, 12, 4), *year])]
    df = spark.createDataFrame(rows, f"i int, m {MONTHS}").withColumn("s", series.sort_monthly("m"))
    out = df.select(
        "i", F.size("s").alias("n"), series.latest_month("s").alias("latest"), series.pct_trend("s", 3).alias("t3"), series.pct_trend("s", 12).alias("t12")
    ).orderBy("i").collect()
    assert [tuple(r)[1:] for r in out] == [
        (12, 30, 0.5, None), (0, None, None, None), (0, None, None, None), (1, 5, None, None), (3, 9, None, None), (13, 30, 0.5, 6.5),
    ]
    # equal months keep their order
    assert [m.search_volume for m in df.where("i = 4").first().s] == [9, 8, 1]


def test_interest_summary(spark):
    rows = [(0, [1.0, 1.0, 1.0, 1.0, 9.0, 9.0, 9.0, 9.0]), (1, [5.0]), (2, []), (3, [9.0, 1.0]), (4, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "i int, v array<double>")
    parts = series.interest_summary("v")
    out = df.select("i", *[c.alias(n) for n, c in parts.items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in out] == [
        (9.0, 5.0, "rising", 8.0), (5.0, 5.0, "flat", 0.0), (None, None, None, None), (1.0, 5.0, "falling", -8.0), (3.0, 2.0, "flat", 2.0),
    ]
