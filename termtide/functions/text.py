"""Text expressions: cleaning, normal forms, tokens, entity unescaping.

Word characters are spelled out as ``[\\p{L}\\p{N}_]``. Java's ``\\w`` is ASCII
without ``(?U)`` and includes combining marks with it, and neither is the contract.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, functions as F

# The character classes of the contract.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x{1c}-\x{1f}]"
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# The named character references that occur most in page text.
NAMED_ENTITIES = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": "\u00a0",
    "copy": "\u00a9",
    "reg": "\u00ae",
    "trade": "\u2122",
    "hellip": "\u2026",
    "mdash": "\u2014",
    "ndash": "\u2013",
    "middot": "\u00b7",
    "bull": "\u2022",
    "laquo": "\u00ab",
    "raquo": "\u00bb",
    "ldquo": "\u201c",
    "rdquo": "\u201d",
    "lsquo": "\u2018",
    "rsquo": "\u2019",
    "deg": "\u00b0",
    "euro": "\u20ac",
    "pound": "\u00a3",
    "eacute": "\u00e9",
    "egrave": "\u00e8",
    "agrave": "\u00e0",
    "ccedil": "\u00e7",
    "auml": "\u00e4",
    "ouml": "\u00f6",
    "uuml": "\u00fc",
    "szlig": "\u00df",
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Cut white space of any kind from both ends."""
    return F.regexp_replace(as_column(c), rf"(?U)^{SPACE}+|{SPACE}+$", "")


def clean(c: Column | str) -> Column:
    """White space runs become one space, ends are trimmed, null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(as_column(c), F.lit("")), rf"(?U){SPACE}+", " "))


def normalize_keyword(c: Column | str) -> Column:
    """Lower case, everything but letters, digits and ``_`` becomes one space."""
    text = F.lower(F.coalesce(as_column(c), F.lit("")))
    return F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}_]+", " "))


def text_key(c: Column | str) -> Column:
    """Case- and edge-insensitive identity of a term."""
    return strip(F.lower(as_column(c)))


def first_token(c: Column | str) -> Column:
    """First run of word characters, '' when there is none."""
    return F.regexp_extract(as_column(c), rf"{WORD}+", 0)


def first_long_token(c: Column | str, longer_than: int = 3) -> Column:
    """First run of word characters with more than ``longer_than`` of them, else ''.

    A run is matched whole, so the pattern cannot start inside a longer word.
    """
    return F.regexp_extract(as_column(c), rf"(?<!{WORD}){WORD}{{{longer_than + 1},}}", 0)


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    """True when any of a fixed list of words occurs as a substring."""
    if not words:
        return F.lit(False)
    return as_column(c).rlike("|".join(re.escape(w) for w in words))


def null_if_nan(c: Column | str) -> Column:
    col = as_column(c).cast("double")
    return F.when(~F.isnan(col), col)


def to_number(c: Column | str) -> Column:
    """Number or null: text that does not parse and NaN both give null."""
    num = as_column(c).try_cast("double")
    return F.when(~F.isnan(num), num)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it.

    Without it a value used n times is n copies in the expression tree, and nested
    uses multiply.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unescape(c: Column | str) -> Column:
    """Resolve named and numeric character references, each once, from left to right."""

    def resolved(t: Column) -> Column:
        pieces = F.split(t, "&")
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _reference)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    return let(as_column(c), lambda t: F.when(t.contains("&"), resolved(t)).otherwise(t))


def _mapping(pairs: dict[str, str]) -> Column:
    """A constant map, read from one literal."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _reference(piece: Column) -> Column:
    """Text that follows an ampersand, with the reference it may start resolved.

    Names are those of HTML5: the longest one stands among those that are legal
    without a semicolon. Numbers without a character give U+FFFD or nothing, as the
    standard says, and those of 0x80 to 0x9F the characters of Windows-1252.
    """
    closed = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    often = {name: closed[name] for name in ("amp", *NAMED_ENTITIES)}
    loose = {name: char for name, char in html5.items() if not name.endswith(";")}
    name = F.regexp_extract(piece, r"^([^\t\n\f <&#;]{1,32});", 1)
    open_name = F.regexp_extract(piece, "^(" + "|".join(sorted(loose, key=len, reverse=True)) + ")", 1)
    number = F.regexp_extract(piece, r"^#(?:0*([0-9]{1,})|[xX][0-9a-fA-F]+);?", 1)
    hexes = F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]+);?", 1)
    too_large = F.lit(0x110000)
    code = F.when(number != "", F.when(F.length(number) > 7, too_large).otherwise(number.try_cast("int"))).when(
        hexes != "", F.when(F.length(hexes) > 6, too_large).otherwise(F.conv(hexes, 16, 10).try_cast("int"))
    )
    windows = {str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}

    def char(n: Column) -> Column:
        none = n.between(1, 8) | n.between(14, 31) | (n == 11) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        lost = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(lost, "\ufffd").when(n.between(0x80, 0x9F), F.element_at(_mapping(windows), n.cast("string"))).when(none, "").otherwise(own)

    named = F.coalesce(F.element_at(_mapping(often), name), F.element_at(_mapping(closed), name))
    by_name = F.concat(named, F.substring(piece, F.length(name) + 2, F.length(piece)))
    by_open_name = F.concat(F.element_at(_mapping(loose), open_name), F.substring(piece, F.length(open_name) + 1, F.length(piece)))
    by_number = F.concat(let(code, char), F.regexp_replace(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", ""))
    return F.coalesce(by_name, by_open_name, by_number, F.concat(F.lit("&"), piece))


def joined_unique(values: Column) -> Column:
    """Array of strings to one '|'-joined string: trimmed, non-empty, distinct, sorted."""
    trimmed = F.transform(F.filter(values, lambda v: v.isNotNull()), strip)
    kept = F.filter(trimmed, lambda v: v != "")
    return F.array_join(F.sort_array(F.array_distinct(kept)), "|")
