"""Main text of web pages: the contiguous region of the highest total score.

A page is a sequence of words and tags. A word scores by how often words in elements of
its kind are content on labelled pages, from 1 if always to 0 if never; in containers with
names that are mostly not content there, it scores negative, down to -1. A tag scores negative, by how often tags of its name are not
content. Tags in parts that are never main text say nothing of their name; inline tags cost
nothing, and inside an article or main element every tag is free and every word counts 1.
One linear scan finds the best contiguous subsequence, and its words, less the parts that
are never main text, are the page's text.

Never main text are menus, forms, asides, scripts and the like by element or role, and
containers by the words of their class and id tokens (comments-area, ad-slot,
newsletter-block). A token that says that such a part is absent or beside (has-sidebar,
no-comments, comments-open) names nothing, and no name applies to what holds the article, to
headings, quotations, code or cells; a paragraph or list item goes only if its class has no
other word. An id of a section often names its subject, so that few words count there.

Labelled pages are those that mark their content with one ``article`` element: what
is inside is content. The weights come from at most ``sample_rows`` of them, those
whose id and html hash lowest; extraction covers every page and all of its html. A kind of
word or name that the sample has not scores 1, a tag that it has not -1.

Definitions: a null or empty page, or one without a word that scores, has empty
text. An empty table gives an empty result. Character references are decoded; white space within a block becomes one
space; blocks are trimmed and joined by two line feeds; br and table cells are
white space, inline elements nothing. Repeated rows are each extracted. Input
columns named like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import slices
from .markup import BLOCKS, CLOSED_BY, SPACED, VOID, attributes_of, tidy, tokens, unescape

SAMPLE_ROWS = 2_000
TAG_WORDS = 5.0
ASIDE_SCORE = -0.1
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
# fixed values: elements, roles and name parts that are never main text
NEVER = frozenset("nav footer aside form menu dialog button select textarea script style noscript template iframe svg math title".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form".split())
# fixed values: words of class and id tokens that name what is never main text
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion promotions banner banners"
    " nav navbar navigation menu menus menubar breadcrumb breadcrumbs sidebar sidebars footer footers cookie cookies consent gdpr notice notices alert alerts"
    " popup popups modal overlay newsletter newsletters subscribe subscription signup login social share sharing related recommended recommendation recommendations"
    " comment comments commentlist disqus discussion discussions reply replies respond pagination pager masthead topbar toolbar widget widgets".split()
)
# fixed values: of these, the ones that as a section's id may be its subject
SUBJECTS = frozenset("advertising notice notices alert alerts social share sharing related recommended recommendation recommendations discussion discussions reply replies promotion promotions login signup subscription navigation cookie cookies consent comment".split())
# fixed values: words that make a token say that something is absent, beside or arranged
ABOUT = frozenset("has no not non with without open closed enabled disabled on off layout template theme grid".split())
# fixed values: whole tokens that count although their words do not
WHOLE = frozenset("side site-header page-header skip-link skip-links skiplink skiplinks".split())
CONTAINERS = frozenset("div section aside ul ol dl center details fieldset header".split())
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup blockquote pre figure figcaption caption dt dd td th table tbody thead tr".split())
PARAGRAPHS = frozenset(("p", "li", *INLINE))
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _never(name: str, more: str, inside: bool) -> bool:
    if name in NEVER or (name == "header" and not inside):
        return True
    if name in ("html", "body", "article", "main") or not more.strip():
        return False
    attributes = attributes_of(more)
    if "hidden" in attributes or attributes.get("aria-hidden", "") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    return attributes.get("role", "").lower() in NEVER_ROLES


def words_of_name(token: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(token)]


def _never_named(name: str, more: str) -> bool:
    if name in ("html", "body", "article", "main") or name in TEXTS or not more.strip():
        return False
    attributes = attributes_of(more)
    for key in ("class", "id"):
        for token in attributes.get(key, "").split():
            words = words_of_name(token)
            if not words or not ABOUT.isdisjoint(words):
                continue
            if name in PARAGRAPHS:
                if key == "class" and all(w in NAMES or w.isdigit() for w in words) and not all(w.isdigit() for w in words):
                    return True
                continue
            found = NAMES.intersection(words)
            if key == "id" and name == "section":
                found -= SUBJECTS
            if found or token.lower().replace("_", "-") in WHOLE:
                return True
    return False


def _names(name: str, more: str) -> tuple[str, ...]:
    """Words of a container's class and id tokens, as features."""
    if name not in CONTAINERS or not more.strip():
        return ()
    attributes = attributes_of(more)
    return tuple({w for key in ("class", "id") for token in attributes.get(key, "").split() for w in words_of_name(token) if not w.isdigit()})


def _wrappers(found: list[tuple[str, str, str]]) -> set[int]:
    """Places of the open tags around an article or main element that is in no other one."""
    stack: list[tuple[str, int]] = []
    out: set[int] = set()
    for i, (kind, name, _) in enumerate(found):
        if kind == "open":
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            if name in ("article", "main") and not any(n in ("article", "main") for n, _ in stack):
                out.update(at for _, at in stack)
            if name not in VOID:
                stack.append((name, i))
        elif kind == "close" and any(n == name for n, _ in stack):
            while stack.pop()[0] != name:
                pass
    return out


def scan(html: str) -> list[tuple[str, str, bool, bool, bool, tuple[str, ...]]]:
    """The page as (kind, value, aside, content, main, names): kind is tag, break, space or the kind of a text; aside: never
    main text; content: inside an article element; main: inside an article or main element; names: words that name the
    containers around a text, less those around the article."""
    out: list[tuple[str, str, bool, bool, bool, tuple[str, ...]]] = []
    stack: list[tuple[str, bool]] = []
    named: list[tuple[str, ...]] = []
    asides = articles = mains = 0

    def pop() -> None:
        nonlocal asides, articles, mains
        name, never = stack.pop()
        named.pop()
        asides -= never
        articles -= name == "article"
        mains -= name in ("article", "main")

    found = list(tokens(html))
    wrappers = _wrappers(found)
    for i, (kind, name, more) in enumerate(found):
        if kind == "text":
            around = stack[-1][0] if stack else ""
            link = any(n == "a" for n, _ in stack[-3:])
            out.append((f"in {around}{' a' if link else ''}", unescape(name), asides > 0, articles > 0, mains > 0, () if mains else tuple({w for words in named for w in words})))
            continue
        if kind == "raw":
            out.append(("tag", name, True, articles > 0, mains > 0, ()))
            continue
        if kind == "open":
            while stack and name in CLOSED_BY.get(stack[-1][0], ()):
                pop()
            if name not in VOID:
                # a name does not make an aside of what holds the article
                never = _never(name, more, mains > 0) or (i not in wrappers and _never_named(name, more))
                stack.append((name, never))
                named.append(() if i in wrappers else _names(name, more))
                asides += never
                articles += name == "article"
                mains += name in ("article", "main")
        elif any(n == name for n, _ in stack):
            while stack[-1][0] != name:
                pop()
            out.append(("tag", f"/{name}", asides > 0, articles > 0, mains > 0, ()))
            pop()
            if name in BLOCKS:
                out.append(("break", "", False, False, False, ()))
            continue
        out.append(("tag", name if kind == "open" else f"/{name}", asides > 0, articles > 0, mains > 0, ()))
        if name in BLOCKS:
            out.append(("break", "", False, False, False, ()))
        elif name in SPACED:
            out.append(("space", "", False, False, False, ()))
    return out


def extract(html: str | None, weights: dict[str, float], any_word: float, any_tag: float) -> str:
    """Text of the page's best region."""
    if not html:
        return ""
    items = scan(html)
    best = score = 0.0
    begin, found = 0, (0, 0)
    for i, (kind, value, aside, _, main, names) in enumerate(items):
        # what is put in between within the marked content neither adds nor parts
        if kind in ("break", "space") or (aside and main):
            continue
        if kind == "tag":
            step = 0.0 if main or value.lstrip("/") in INLINE else weights.get(f"<{value}>", any_tag)
        else:
            words = len(value.split())
            # a name that stands for the opposite of content turns the score
            named = min((weights.get(f"named {w}", 1.0) for w in names), default=1.0)
            step = words * (ASIDE_SCORE if aside else 1.0 if main else 2 * named - 1 if named < 0.5 else weights.get(kind, any_word))
        if score <= 0:
            score, begin = 0.0, i
        score += step
        if score > best:
            best, found = score, (begin, i + 1)
    blocks, parts = [], []
    for kind, value, aside, _, _, _ in items[found[0] : found[1]]:
        if kind == "break":
            blocks.append(tidy(parts))
            parts = []
        elif kind == "space":
            parts.append(" ")
        elif kind != "tag" and not aside:
            parts.append(value)
    blocks.append(tidy(parts))
    return "\n\n".join(b for b in blocks if b)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_rows: int = SAMPLE_ROWS) -> dict[str, float]:
    """Weights by kind of word and tag; the keys ``word`` and ``tag`` are for all others."""
    labelled = pages.where(F.lower(html_col).contains("<article")).select(F.xxhash64(id_col, html_col).alias("h"), F.col(html_col).alias("html"))
    ids = labelled.select("h").distinct().orderBy("h").limit(sample_rows)
    # equal rows are one, so that the bound holds
    sample = labelled.join(F.broadcast(ids), "h").dropDuplicates(["h"]).select("html")

    def count(batches):
        seen: Counter[tuple[str, bool]] = Counter()
        for batch in slices(batches, 0):
            for html in batch.column(0).to_pylist():
                items = scan(html)
                if sum(kind == "tag" and value == "article" for kind, value, *_ in items) != 1:
                    continue
                for kind, value, aside, content, _, names in items:
                    if aside or kind in ("break", "space"):
                        continue
                    if kind == "tag":
                        seen[f"<{value}>", content] += 1
                    else:
                        words = len(value.split())
                        seen[kind, content] += words
                        for w in names:
                            seen[f"named {w}", content] += words
        kinds = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kinds], pa.string()), pa.array([c for _, c in kinds], pa.bool_()), pa.array([seen[k] for k in kinds], pa.int64())], names=["kind", "content", "n"])

    counts = sample.mapInArrow(count, "kind string, content boolean, n long").groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("content"), F.col("n")).otherwise(0)).alias("c"))
    weights = {"word": 1.0, "tag": -1.0}
    # bounded by the sample: its names of elements, classes and ids
    for row in counts.collect():
        share = (row["c"] + 0.5) / (row["n"] + 1)
        weights[row["kind"]] = -TAG_WORDS * (1 - share) if row["kind"].startswith("<") else share
    return weights


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """All rows with text and n_chars (code points)."""
    carried = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    size = len(carried)
    names = [*[f"c{i}" for i in range(size)], "text", "n_chars"]

    def run(batches):
        for batch in slices(batches, size):
            texts = [extract(html, weights, weights["word"], weights["tag"]) for html in batch.column(size).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=names)

    schema = T.StructType([T.StructField(f"c{i}", pages.schema[c].dataType) for i, c in enumerate(carried)]).add("text", "string").add("n_chars", "long")
    rows = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(html_col).cast("string").alias("__html"))
    return rows.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "text", "n_chars")
