"""A forgiving scanner of html: tags, texts and blocks, without a document tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

# comments, declarations, elements whose content is not markup, tags, text
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(script|style|noscript|template|textarea|iframe|svg|math|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset(("br", "td", "th", "wbr", "img", "input", "button"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# an open paragraph or item ends where one of these begins
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)), "tr": frozenset(("tr",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr"))}


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kind is open, close, text or raw (an element whose content is no markup)."""
    for match in _TOKEN.finditer(html):
        raw, slash, name, attributes = match.groups()
        if name:
            yield ("close" if slash else "open", name.lower(), attributes)
        elif raw:
            yield ("raw", raw.lower(), match.group())
        elif match.group()[:2] not in ("<!", "<?"):
            yield ("text", match.group(), "")


def attributes_of(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def tidy(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def plain_text(html: str) -> tuple[str, str, list[str]]:
    """Title, all visible text (a line for each block) and link targets, in page order."""
    title, lines, links, parts = "", [], [], []
    for match in _TOKEN.finditer(html):
        raw, slash, name, attributes = match.groups()
        if name:
            name = name.lower()
            if name in BLOCKS:
                if parts:
                    lines.append(tidy(parts))
                    parts = []
            elif name in SPACED:
                parts.append(" ")
            elif name == "a" and not slash and (target := attributes_of(attributes).get("href", "").strip()):
                links.append(target)
        elif raw:
            if raw.lower() == "title" and not title:
                title = tidy([unescape(re.sub(r"<[^>]*>", "", match[0]))])
        else:
            text = match[0]
            if text[:2] not in ("<!", "<?"):
                parts.append(unescape(text) if "&" in text else text)
    lines.append(tidy(parts))
    return title, "\n".join(line for line in lines if line), links
