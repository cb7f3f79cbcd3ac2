"""Page expressions: what a page's html and url say, by regular expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column, clean, let, strip, unescape

# Elements whose text is not main text.
NON_TEXT_TAGS = ("script", "style", "nav", "footer", "header")
CONTENT_TYPES = ("contest", "reading", "echo", "home", "page")

TAG = r"</?[a-zA-Z!][^>]*>"
COMMENT = r"(?s)<!--.*?-->"
URL_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _block(tag: str) -> str:
    return rf"(?is)<{tag}\b.*?</{tag}\s*>"


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in one start tag, '' when absent."""
    pattern = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return unescape(F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]))


def markup(html: Column | str) -> Column:
    """The html without comments, scripts and styles: only real elements remain."""
    out = F.regexp_replace(F.coalesce(as_column(html), F.lit("")), COMMENT, "")
    for tag in ("script", "style"):
        out = F.regexp_replace(out, _block(tag), "")
    return out


def page_lang(html: Column | str) -> Column:
    return _attribute(F.regexp_extract(as_column(html), r"(?is)<html\b[^>]*>", 0), "lang")


def page_title(html: Column | str) -> Column:
    return strip(unescape(F.regexp_extract(as_column(html), r"(?is)<title\b[^>]*>(.*?)</title", 1)))


def page_meta(html: Column | str) -> Column:
    """Content of the description meta tag, whatever the order of its attributes."""
    tag = F.regexp_extract(
        as_column(html),
        r"(?is)<meta\b[^>]*?\sname\s*=\s*(?-i:\"description\"|'description'|description[\s/>])[^>]*>?",
        0,
    )
    return strip(_attribute(tag, "content"))


def canonical_url(url: Column | str, html: Column | str) -> Column:
    """The canonical href when the page names one, else the url it was fetched by."""
    tag = F.regexp_extract(
        as_column(html), r"(?is)<link\b[^>]*?\srel\s*=\s*[\"']?[^\"'>]*?\bcanonical\b[^>]*>", 0
    )
    return F.coalesce(F.nullif(strip(_attribute(tag, "href")), F.lit("")), as_column(url))


def page_headings(html: Column | str, level: int) -> Column:
    """All headings of a level joined by ' | '; text pieces inside one are glued."""
    inner = F.regexp_extract_all(as_column(html), F.lit(rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}\s*>"), F.lit(1))

    def text(fragment: Column) -> Column:
        return strip(unescape(F.regexp_replace(fragment, rf"\s*{TAG}\s*", "")))

    return F.array_join(F.transform(inner, text), " | ")


def main_text(html: Column | str) -> Column:
    """Visible text: comments, boilerplate elements and tags go, spaces collapse."""
    out = F.regexp_replace(F.coalesce(as_column(html), F.lit("")), COMMENT, "")
    for tag in NON_TEXT_TAGS:
        out = F.regexp_replace(out, _block(tag), " ")
    return clean(unescape(F.regexp_replace(out, TAG, " ")))


# -- urls ---------------------------------------------------------------------


def url_part(url: Column | str, part: str) -> Column:
    """``scheme``, ``host``, ``path`` or ``query`` of a url, '' when absent."""
    group = {"scheme": 1, "host": 2, "path": 3, "query": 4}[part]
    return F.regexp_extract(as_column(url), URL_PARTS, group)


def content_type(url: Column | str) -> Column:
    """Type by substrings of the lower-cased path and query, first match wins."""
    path = url_part(url, "path")
    target = F.concat(F.lower(path), F.lit("?"), F.lower(url_part(url, "query")))
    return (
        F.when(target.contains("contest"), "contest")
        .when(target.contains("read") | target.contains("book"), "reading")
        .when(target.contains("echo") | target.contains("chat"), "echo")
        .when(path.isin("", "/"), "home")
        .otherwise("page")
    )


def page_ids(url: Column | str) -> dict[str, Column]:
    """The id parameter, routed to one of three columns by content type."""
    found = F.regexp_extract(as_column(url), r"[?&]id=([0-9]+)", 1)
    kind = content_type(url)
    routes = {"course_id": "contest", "reading_id": "reading", "echo_id": "echo"}
    return {name: F.when(kind == wanted, found).otherwise("") for name, wanted in routes.items()}


def _directory(segments: Column) -> Column:
    """Path segments without the part after the last slash."""
    cut = F.slice(segments, F.lit(1), F.size(segments) - 1)
    return F.when(F.element_at(segments, -1) != "", cut).otherwise(segments)


def _without_empty_middle(segments: Column) -> Column:
    middle = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 2, F.lit(0)))
    kept = F.filter(middle, lambda s: s != "")
    ends = F.slice(segments, F.lit(1), F.lit(1)), F.array(F.element_at(segments, -1))
    return F.when(F.size(segments) > 1, F.concat(ends[0], kept, ends[1])).otherwise(segments)


def _step(done: Column, segment: Column) -> Column:
    parent = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    return (
        F.when(segment == "..", parent).when(segment == ".", done).otherwise(F.concat(done, F.array(segment)))
    )


def _joined(segments: Column) -> Column:
    """Segments to a path, dot segments resolved."""
    walked = F.aggregate(segments, F.array().cast("array<string>"), _step)
    dotted = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.when(dotted, F.concat(walked, F.array(F.lit("")))).otherwise(walked), "/")


def _merged_path(base_path: Column, path: Column) -> Column:
    """Path of a reference against a base path."""
    from_base = let(F.concat(let(F.split(base_path, "/"), _directory), F.split(path, "/")), _without_empty_middle)
    joined = let(F.when(path.startswith("/"), F.split(path, "/")).otherwise(from_base), _joined)
    # too many '..' eat the leading slash
    return F.regexp_replace(joined, r"^/?", "/")


def url_parts(url: Column | str) -> Column:
    """Struct of scheme, host, path and query; null url parts count as ''."""
    return F.struct(*[url_part(url, p).alias(p) for p in ("scheme", "host", "path", "query")])


def _query_of(parts: Column) -> Column:
    return F.when(parts["query"] != "", F.concat(F.lit("?"), parts["query"])).otherwise("")


def _resolved(base: Column, ref: Column, own: Column) -> Column:
    scheme = F.lower(base["scheme"])
    site = F.concat(scheme, F.lit("://"), base["host"])
    foreign = (own["scheme"] != "") & (F.lower(own["scheme"]) != scheme)
    same_page = F.concat(site, base["path"], F.when(own["query"] != "", _query_of(own)).otherwise(_query_of(base)))
    return (
        F.when(foreign, F.regexp_replace(ref, r"#.*$", ""))
        .when(own["host"] != "", F.concat(scheme, F.lit("://"), own["host"], own["path"], _query_of(own)))
        .when(own["path"] == "", same_page)
        .otherwise(F.concat(site, _merged_path(base["path"], own["path"]), _query_of(own)))
    )


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute url of ``href`` seen from a page with the given ``url_parts``, fragment cut."""
    bare = F.regexp_replace(F.regexp_replace(href, r"[\r\n\t]", ""), r"^[\x{00}-\x{20}]+|[\x{00}-\x{20}]+$", "")
    return let(bare, lambda ref: let(url_parts(ref), lambda own: _resolved(base, ref, own)))


def internal_links(url: Column | str, html: Column | str) -> Column:
    """Distinct sorted links of a page that stay on its host."""
    tags = F.regexp_extract_all(as_column(html), F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))
    with_href = F.filter(tags, lambda t: t.rlike(r"(?is)\shref(?:\s*=|[\s/>])"))

    def on_host(base: Column) -> Column:
        links = F.transform(with_href, lambda t: resolve_url(base, _attribute(t, "href")))
        return F.filter(links, lambda link: url_part(link, "host") == base["host"])

    return F.sort_array(F.array_distinct(let(url_parts(url), on_host)))
