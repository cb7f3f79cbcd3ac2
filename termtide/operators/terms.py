"""Candidate terms with provenance, mined from pages and entity exports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import FALLBACK_LANGUAGE, LANGUAGES, LanguageSignals
from ..functions.text import EDGE, WORD, as_column, clean, strip
from ..schemas import CANDIDATES
from ..session import stage

# What counts as a quoted span, a question and a capitalized span.
QUOTED = r"[\"“«]([^\"”»]{3,80})[\"”»]"
QUESTION_WORDS = (
    "why", "how", "who", "what", "when", "where", "did", "is", "was",
    "почему", "как", "кто", "что", "когда", "где",
)
# what a match may begin with is looked at first: most places of a text need no look behind them
QUESTION_START = r"(?=[DHIWdhiw\x{130}-\x{4ff}])"
QUESTION = rf"{QUESTION_START}(?iu)(?<!{WORD})((?:{'|'.join(QUESTION_WORDS)})(?!{WORD})[^.?!]{{5,80}}\??)"
NAME = r"[A-Z][\p{L}\p{N}_'’]+"
CAPITALIZED = rf"(?U)(?=[A-Z])(?<!{WORD})({NAME}(?:\s+(?:of|the|and|de|van|von)?\s*{NAME}){{0,4}}){EDGE}"
MIN_TERM, MAX_TERM, MIN_SINGLE = 3, 90, 4

# Order in which one source row yields its terms.
KIND = {"title": 0, "h1": 1, "h2": 2, "h3": 3, "quoted_span": 4, "question_regex": 5, "capitalized_span": 6}

# Entity columns and the term type each one gives.
ENTITY_COLUMNS = (
    ("title", "page_title"),
    ("base_text_title", "book_title"),
    ("base_text_author", "author"),
    ("contest_title", "page_title"),
)

SOURCE = ("source_url", "source_entity_type", "source_entity_id", "lang")
# more terms than an array can have
PLACES = 1 << 31


def _entries(values: Column, kind: int, term_type: str, method: str) -> Column:
    """Array of strings to an array of term entries that remember their place."""
    return F.transform(
        values,
        lambda term, pos: F.struct(
            F.lit(kind).alias("kind"),
            pos.cast("int").alias("pos"),
            term.alias("term"),
            F.lit(term_type).alias("term_type"),
            F.lit(method).alias("extraction_method"),
        ),
    )


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _in_length(entries: Column) -> Column:
    cleaned = F.transform(entries, lambda e: e.withField("term", clean(e["term"])))
    return F.filter(cleaned, lambda e: F.length(e["term"]).between(MIN_TERM, MAX_TERM))


def quoted_entries(text: Column) -> Column:
    return _in_length(_entries(_all(text, QUOTED), KIND["quoted_span"], "book_title", "quoted_span"))


def question_entries(text: Column) -> Column:
    return _in_length(_entries(_all(text, QUESTION), KIND["question_regex"], "question_phrase", "question_regex"))


def entity_entries(text: Column) -> Column:
    entries = _entries(_all(text, CAPITALIZED), KIND["capitalized_span"], "character", "capitalized_span")
    return F.filter(entries, lambda e: e["term"].contains(" ") | (F.length(e["term"]) >= MIN_SINGLE))


def _mined(df: DataFrame, text: str, entries) -> DataFrame:
    rest = [c for c in df.columns if c != text]
    prepared = df.withColumn("_text", clean(text))
    found = prepared.select(*rest, F.explode(entries(F.col("_text"))).alias("_e"))
    return found.select(*rest, "_e.pos", "_e.term", "_e.term_type", "_e.extraction_method")


def quoted_terms(df: DataFrame, text: str) -> DataFrame:
    """One row per quoted span of 3 to 80 characters."""
    return _mined(df, text, quoted_entries)


def question_terms(df: DataFrame, text: str) -> DataFrame:
    """One row per question phrase."""
    return _mined(df, text, question_entries)


def entity_terms(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """One row per (document, capitalized span) with its count and first position."""
    spans = _mined(df.select(*keys, text), text, entity_entries)
    return spans.groupBy(*keys, "term", "term_type", "extraction_method").agg(
        F.count("*").alias("term_count"), F.min("pos").alias("first_pos")
    )


def title_terms(pages: DataFrame, *keep: str) -> DataFrame:
    kept = pages.where(F.col("title") != "")
    return kept.select(
        *keep, F.col("title").alias("term"), F.lit("page_title").alias("term_type"),
        F.lit("title").alias("extraction_method"),
    )


def _heading_parts(column: str) -> Column:
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), r" \| "), strip)
    return F.filter(_entries(parts, KIND[column], "heading", column), lambda e: e["term"] != "")


def heading_terms(pages: DataFrame, *keep: str) -> DataFrame:
    parts = F.concat(*[_heading_parts(c) for c in ("h1", "h2", "h3")])
    rows = pages.select(*keep, F.explode(parts).alias("_e"))
    return rows.select(*keep, "_e.pos", "_e.term", "_e.term_type", "_e.extraction_method")


def _one_entry(value: Column, kind: int, term_type: str, method: str) -> Column:
    return F.filter(_entries(F.array(value), kind, term_type, method), lambda e: e["term"] != "")


def collapse_terms(df: DataFrame, order: str = "ord") -> DataFrame:
    """One row per (lower-cased term, type): counts summed, the rest from the first row.

    Sums and firsts combine before the shuffle, so a term found everywhere
    arrives as one row per map task.
    """
    rest = [c for c in CANDIDATES.fieldNames() if c not in ("term_type", "term_count")]
    grouped = df.groupBy(F.lower("term").alias("_key"), "term_type").agg(
        F.sum("term_count").alias("term_count"), F.min_by(F.struct(*rest), F.struct(order, *rest)).alias("_first")
    )
    return grouped.select("_first.*", "term_type", "term_count").select(*CANDIDATES.fieldNames())


def page_rows(pages: DataFrame, order: str = "url") -> DataFrame:
    """Every page with what its terms have in common and ``entries``, its terms in reading order, in one pass."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    prepared = pages.select(
        F.col(order).alias("_row"),
        text("url").alias("source_url"),
        text("content_type").alias("source_entity_type"),
        F.lit("").alias("source_entity_id"),
        F.substring(text("lang"), 1, 2).alias("lang"),
        text("title").alias("_title"),
        "h1", "h2", "h3",
        clean(F.concat_ws(" ", text("meta_description"), text("body_text"))).alias("_text"),
    )
    entries = F.concat(
        _one_entry(F.col("_title"), KIND["title"], "page_title", "title"),
        *[_heading_parts(c) for c in ("h1", "h2", "h3")],
        quoted_entries(F.col("_text")),
        question_entries(F.col("_text")),
        entity_entries(F.col("_text")),
    )
    return prepared.select("_row", *SOURCE, "_title", F.lit(True).alias("_titled"), entries.alias("entries"))


def entity_rows(entities: DataFrame, order: str = "entity_id") -> DataFrame:
    """Every entity row likewise; terms of its description have no title."""
    prepared = entities.select(
        F.col(order).alias("_row"),
        F.coalesce("public_url", F.lit("")).alias("source_url"),
        F.coalesce("entity_type", F.lit("")).alias("source_entity_type"),
        F.coalesce("entity_id", F.lit("")).alias("source_entity_id"),
        F.substring(F.coalesce("lang", F.lit("")), 1, 2).alias("lang"),
        F.coalesce("title", F.lit("")).alias("_title"),
        *[clean(name).alias(f"_{name}_term") for name, _ in ENTITY_COLUMNS],
        clean("description").alias("_text"),
    )
    named = [
        _one_entry(F.col(f"_{name}_term"), i, term_type, f"db:{name}")
        for i, (name, term_type) in enumerate(ENTITY_COLUMNS)
    ]
    text = F.col("_text")
    entries = F.concat(*named, quoted_entries(text), question_entries(text), entity_entries(text))
    return prepared.select("_row", *SOURCE, "_title", F.lit(False).alias("_titled"), entries.alias("entries"))


def first_terms(rows: DataFrame) -> DataFrame:
    """One row per (lower-cased term, type): occurrences counted, the rest from the first one in reading order.

    Rows are read in the order of ``_row``, rows equal in it by a hash of their content. They are
    written in that order, each with a rising address, so that an occurrence's place is a number
    and occurrences are hashed and combined map-side without their texts. Only the first of each
    term is fetched, by its address.
    """
    found = stage(rows, "mined")
    content = F.xxhash64(*[c for c in found.columns if c != "_row"])
    placed = stage(found.orderBy("_row", content).drop("_row").withColumn("_at", F.monotonically_increasing_id()), "mined-in-order")
    seen = placed.select("_at", F.posexplode("entries").alias("_pos", "_e"))
    place = F.col("_at").cast("decimal(19,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("_pos").cast("decimal(10,0)")
    firsts = seen.groupBy(F.lower("_e.term").alias("_key"), F.col("_e.term_type").alias("term_type")).agg(
        F.count("*").alias("term_count"), F.min(place).alias("_place")
    )
    winners = firsts.select(
        "term_type", "term_count", F.expr(f"_place div {PLACES}").alias("_at"), F.expr(f"_place % {PLACES}").cast("int").alias("_pos")
    )
    fetched = winners.join(placed, "_at").withColumn("_e", F.get("entries", F.col("_pos")))
    titled = F.col("_titled") | (F.col("_e.kind") < KIND["quoted_span"])
    return fetched.select(
        F.col("_e.term").alias("term"), *SOURCE, "term_type", "term_count",
        F.when(titled, F.col("_title")).otherwise("").alias("source_title"), F.col("_e.extraction_method").alias("extraction_method"),
    )


def mine_pages(pages: DataFrame, order: str = "url") -> DataFrame:
    return first_terms(page_rows(pages, order))


def mine_entities(entities: DataFrame, order: str = "entity_id") -> DataFrame:
    return first_terms(entity_rows(entities, order))


def union_candidates(*families: DataFrame) -> DataFrame:
    """All families in order; the first row per (term, type, source url) stays."""
    keys = ["term", "term_type", "source_url"]
    rest = [c for c in CANDIDATES.fieldNames() if c not in keys]
    parts = [f.select(*CANDIDATES.fieldNames()).withColumn("_family", F.lit(i)) for i, f in enumerate(families)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    first = F.min_by(F.struct(*rest), F.struct("_family", *rest))
    return together.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*").select(*CANDIDATES.fieldNames())


def term_type_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("term_type").agg(F.count("*").alias("terms"))


def repeated_phrases(
    df: DataFrame,
    text: str,
    lang: str,
    languages: Mapping[str, LanguageSignals] = LANGUAGES,
    sizes: tuple[int, ...] = (2, 3, 4),
    min_docs: int = 2,
    parts: int | None = None,
) -> DataFrame:
    """Word n-grams without a stopword at either end, found in several documents.

    A document yields each phrase once, so counting rows counts documents. Stopwords are
    single words; which words are is found once per word, not once per phrase.

    Phrases that begin at one word are sent as one row: the longest of them, which the others
    begin, and which of them a document has not sent yet. Rows meet in ``parts`` by what the shortest
    phrase is, and are told apart and counted there.
    """
    sizes = tuple(sorted(set(sizes)))
    mark = {n: chr(ord("a") + k) for k, n in enumerate(sizes)}
    words = F.regexp_extract_all(F.lower(as_column(text)), F.lit(r"[\p{L}\p{N}_'’]+"), F.lit(0))
    rows = df.select(F.substring(F.coalesce(F.col(lang), F.lit("")), 1, 2).alias("_lang"), words.alias("_words"))
    named = [(name, signals.stopwords) for name, signals in languages.items() if name != FALLBACK_LANGUAGE]

    def is_stopword(word: Column) -> Column:
        found = word.isin(*languages[FALLBACK_LANGUAGE].stopwords)
        for name, stopwords in named:
            found = F.when(F.col("_lang") == name, word.isin(*stopwords)).otherwise(found)
        return found

    rows = rows.select(F.transform("_words", is_stopword).alias("_stops"), F.transform("_words", lambda w: F.concat(F.lit(" "), w)).alias("_words"))

    def is_phrase(i: Column, n: int) -> Column:
        """Whether ``n`` words from a place on are one; null beyond the text's end."""
        if n == 1:
            return F.lit(True)
        return ~F.get("_stops", i + n - 1) & ~F.get("_stops", i) if 1 in sizes else ~F.get("_stops", i + n - 1)

    def longest(i: Column) -> Column:
        """The longest phrase from a place on, each word after a space, then which shorter ones there are."""
        found = F.when(F.lit(False), "")
        for n in sizes[::-1]:
            shorter = [F.when(is_phrase(i, m), mark[m]).otherwise("") for m in sizes if m < n]
            found = found.when(is_phrase(i, n), F.concat(*[F.get("_words", i + j) for j in range(n)], F.lit(f"\t{mark[n]}"), *shorter))
        return found

    places = F.when(F.size("_words") > 0, F.sequence(F.lit(0), F.size("_words") - 1)).otherwise(F.array().cast("array<int>"))
    if 1 not in sizes:
        places = F.filter(places, lambda i: ~F.get("_stops", i))
    # sorted, phrases that begin alike stand together: no word has a character before the space
    ordered = rows.select(F.sort_array(F.array_compact(F.transform(places, longest))).alias("_found"))
    pairs = ordered.select(F.explode(F.transform("_found", lambda x, i: F.struct(x.alias("own"), F.get("_found", i - 1).alias("last")))).alias("_p"))
    new = pairs.where(~F.col("_p.own").eqNullSafe(F.col("_p.last")))
    # what is used several times is a column of its own, made once
    texts = new.select(
        F.substring_index("_p.own", "\t", 1).alias("_own"), F.substring_index("_p.last", "\t", 1).alias("_last"), F.substring_index("_p.own", "\t", -1).alias("_marks")
    )
    begun = texts.select("*", F.substring_index("_own", " ", sizes[0] + 1).alias("_head"))

    def fresh(n: int) -> Column:
        """Whether the phrase of ``n`` words is one that the row before did not begin with."""
        own = F.col("_head") if n == sizes[0] else F.substring_index("_own", " ", n + 1)
        return F.contains("_marks", F.lit(mark[n])) & ~own.eqNullSafe(F.substring_index("_last", " ", n + 1))

    flags = reduce(Column.__add__, [F.when(fresh(n), 1 << k).otherwise(0) for k, n in enumerate(sizes)])
    # in order, like rows stand together and are packed together
    sent = begun.select("_head", F.substring("_own", F.length("_head") + 1, F.length("_own")).alias("_tail"), flags.alias("_fresh")).sortWithinPartitions("_head", "_tail")
    met = sent.repartition(parts, "_head") if parts else sent.repartition("_head")
    kinds = [F.when(F.col("_fresh").bitwiseAND(F.lit(1 << k)) > 0, F.substring_index("_tail", " ", n - sizes[0] + 1)) for k, n in enumerate(sizes)]
    phrases = met.select("_head", F.explode(F.array(*kinds)).alias("_rest")).where(F.col("_rest").isNotNull())
    counted = phrases.groupBy("_head", "_rest").agg(F.count("*").alias("doc_count"))
    term = F.concat(F.substring(F.col("_head"), 2, 2**31 - 1), "_rest")
    return counted.where(F.col("doc_count") >= min_docs).select(
        term.alias("term"), F.lit("noun_phrase").alias("term_type"), "doc_count", F.lit("repeated_phrase").alias("extraction_method")
    )
