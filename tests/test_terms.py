"""Term mining against a plain Python reading of the same definitions."""

import re

from pyspark.sql import functions as F

from termtide.functions.text import EDGE, WORD
from termtide.operators import terms
from termtide.operators.planning import select_terms
from termtide.schemas import CANDIDATES

TEXTS = [
    "Prince Hamlet met Ophelia of the North. Why did Hamlet wait so long? \"To Be Or Not\" is a line.",
    "Holmes' book and Arthur Conan Doyle's stories. Is is was it? «Война и мир» Почему он молчит так долго?",
    "A B. Of The Rings and the Two Towers de la Mancha van Gogh Van Gogh of",
    "Élan Éa Straße Zürich O'Neil D'' Xy' Ab’c. how: island history. \"ab\" “abc” \"" + "y" * 81 + "\"",
    "why " + "x " * 60 + "why not so fast",
    "", "   ", "Foo  Bar Baz\nQux. Ho",
]


def python_spans(raw):
    t = re.sub(r"\s+", " ", raw).strip()
    quoted = [m.strip() for m in re.findall(r"[\"“«]([^\"”»]{3,80})[\"”»]", t)]
    words = "|".join(terms.QUESTION_WORDS)
    asked = [m.strip() for m in re.findall(rf"\b((?:{words})\b[^.?!]{{5,80}}\??)", t, re.IGNORECASE)]
    names = re.findall(r"\b([A-Z][\w'’]+(?:\s+(?:of|the|and|de|van|von)?\s*[A-Z][\w'’]+){0,4})\b", t)
    in_length = lambda s: 3 <= len(s) <= 90
    return (
        [q for q in quoted if in_length(q)], [q for q in asked if in_length(q)],
        [n for n in names if len(n.split()) > 1 or len(n) >= 4],
    )


def test_spans_equal_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    texts = TEXTS + [r.text for r in docs.collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    for which, operator in ((0, terms.quoted_terms), (1, terms.question_terms)):
        rows = operator(df, "t").orderBy("i", "pos").collect()
        found = {i: [r.term for r in rows if r.i == i] for i in range(len(texts))}
        assert found == {i: python_spans(t)[which] for i, t in enumerate(texts)}
    counted = {(r.i, r.term): r.term_count for r in terms.entity_terms(df, "t", "i").collect()}
    expected = {}
    for i, t in enumerate(texts):
        for name in python_spans(t)[2]:
            expected[i, name] = expected.get((i, name), 0) + 1
    assert counted == expected


def test_collapse_keeps_sums_and_first_rows(spark):
    rows = [("Hamlet", "u1", 1, 2), ("hamlet", "u2", 3, 1), ("HAMLET", "u3", 5, 3), ("Other", "u4", 2, 4)]
    df = spark.createDataFrame(rows, "term string, source_url string, term_count bigint, ord int").withColumns(
        {c: F.lit("") for c in ("source_entity_type", "source_entity_id", "lang", "source_title", "extraction_method")}
    ).withColumn("term_type", F.lit("character"))
    out = {r.term: (r.source_url, r.term_count) for r in terms.collapse_terms(df).collect()}
    assert out == {"hamlet": ("u2", 9), "Other": ("u4", 2)}


def test_first_terms_by_place(spark):
    ddl = "url string, lang string, title string, meta_description string, h1 string, h2 string, h3 string, body_text string, content_type string"
    rows = [
        ("b", "en", "HAMLET", "", "", "", "", "He met Old Hamlet and Old Hamlet.", "page"), ("a", "en-GB", "", "", "hamlet | Hamlet", "", "", "Then OLD HAMLET left. Old Hamlet!", "book"),
        (None, None, None, None, None, None, None, "So Old Hamlet", None), ("c", "en", "", "", "", "", "", "", "page"), ("c", "en", "", "", "", "", "", "", "page"),
        ("d", "en", "Twice", "", "", "", "", "", "page"), ("d", "en", "Twice", "", "", "", "", "", "page"),
    ]
    pages = spark.createDataFrame(rows, ddl)
    for df in (pages.repartition(5), pages.coalesce(1)):
        found = terms.mine_pages(df)
        assert found.columns == CANDIDATES.fieldNames() and found.schema["term_count"].dataType.typeName() == "long"
        got = {(r.term, r.term_type): (r.source_url, r.lang, r.term_count, r.source_title, r.extraction_method) for r in found.collect()}
        assert got["HAMLET", "page_title"] == ("b", "en", 1, "HAMLET", "title")
        assert got["hamlet", "heading"] == ("a", "en", 2, "", "h1")
        # a missing url is read first
        counted = {t.lower(): v for (t, kind), v in got.items() if kind == "character"}
        assert counted["old hamlet"][:3] == ("", "", 4) or counted["so old hamlet"][:3] == ("", "", 1)
        assert got["Twice", "page_title"] == ("d", "en", 2, "Twice", "title")
    assert terms.mine_pages(pages.limit(0)).collect() == []


def test_terms_are_hashed_not_sorted(spark):
    rows = spark.createDataFrame([(1, "u", "t", "i", "en", "x", True, [(0, 0, "Term", "heading", "h1")])], "_row int, source_url string, source_entity_type string, source_entity_id string, lang string, _title string, _titled boolean, entries array<struct<kind:int,pos:int,term:string,term_type:string,extraction_method:string>>")
    found = terms.first_terms(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert [tuple(r) for r in found.collect()] == [("Term", "u", "t", "i", "en", "heading", 1, "x", "h1")]


def test_select_terms_cut(spark):
    ddl = "term string, source_url string, source_entity_id string, term_type string, term_count bigint"
    rows = [("Same", "b", "", "heading", 5), ("same ", "a", "", "heading", 5), ("x", None, None, "heading", None), ("y", "u", "", "heading", 2**62), ("low", "u", "", "unknown", 9), ("top", "u", "", "book_title", 1), ("SAME", "u", "", "unknown", 99)]
    df = spark.createDataFrame(rows, ddl)
    assert [r.term for r in select_terms(df, 10).collect()] == ["top", "x", "y", "Same", "low"]
    assert [r.term for r in select_terms(df.repartition(4), 4).collect()] == ["top", "x", "y", "Same"]
    assert select_terms(df, 0).collect() == [] and select_terms(df.limit(0), 3).collect() == []


def test_pages_come_before_entities_and_priorities_hold(spark):
    ddl = ("term string, source_url string, source_entity_type string, source_entity_id string, lang string, term_type string, "
           "term_count bigint, source_title string, extraction_method string")
    pages = spark.createDataFrame([("A title", "u", "page", "", "en", "page_title", 1, "A title", "title")], ddl)
    entities = spark.createDataFrame(
        [("A title", "u", "book", "7", "en", "page_title", 1, "A title", "db:title"), ("a TITLE ", "v", "book", "8", "en", "book_title", 1, "", "db:x"),
         ("zeta", "v", "", "", "en", "unknown", 99, "", "m"), ("many", "v", "", "", "en", "character", 5, "", "m"), ("few", "v", "", "", "en", "character", 2, "", "m")],
        ddl,
    )
    both = terms.union_candidates(pages, entities)
    assert both.where("term = 'A title'").first().extraction_method == "title"
    assert [r.term for r in select_terms(both, 3).collect()] == ["a TITLE ", "many", "few"]
    assert select_terms(both, 10).count() == 4


def test_repeated_phrases(spark):
    rows = [(1, "The green light of hope", "en"), (2, "the Green Light, again", "en"), (3, "и зелёный свет", "ru"), (4, "зелёный свет и", "ru"), (5, "one green", None)]
    df = spark.createDataFrame(rows, "i int, t string, lang string")
    found = {r.term: r.doc_count for r in terms.repeated_phrases(df, "t", "lang").collect()}
    assert found == {"green light": 2, "зелёный свет": 2}


def test_patterns_pass_over_places_where_no_match_can_begin(spark):
    """The patterns as the contract words them, and ours, that look at the first letter before they look behind it."""
    asked = rf"(?iu)(?<!{WORD})((?:{'|'.join(terms.QUESTION_WORDS)})(?!{WORD})[^.?!]{{5,80}}\??)"
    named = rf"(?U){EDGE}({terms.NAME}(?:\s+(?:of|the|and|de|van|von)?\s*{terms.NAME}){{0,4}}){EDGE}"
    odd = ["İs it so, then", "ıs it so, then", "waſ it so, then", "ſis it so", "éis it so", "ГДЕ он живёт", "огде он живёт", "КАК-то раз было", "1Why not so", "_Why not so",
           "ÉAb Éa xAb Ab_ A'b. 'Ab' _Ab ́Ab 9Ab", "The Cat of The\nDog", "ПОЧЕМУ ПОЧЕМУ ПОЧЕМУ", "whý not so fast", "\U0001d400Why not so"]
    texts = spark.createDataFrame([(t,) for line in TEXTS + odd for t in (line, line.upper(), line.lower(), f"x{line}")], "t string")
    for plain, ours in ((asked, terms.QUESTION), (named, terms.CAPITALIZED)):
        assert re.match(r"(?:\(\?[a-zA-Z]+\))?\(\?=\[", ours)
        found = texts.select("t", terms._all(F.col("t"), plain).alias("plain"), terms._all(F.col("t"), ours).alias("ours")).collect()
        assert [r.plain for r in found] == [r.ours for r in found] and sum(len(r.ours) for r in found) > 30
