"""Candidate-term mining, selection and request planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import IDEAS_TERMS, KNOWN_LOGS
from ..functions.text import clean
from ..operators import planning, terms as op
from ..session import new_folder, stage
from ..schemas import CANDIDATES
from ..sources import raw as raw_io, tables
from ..streaming import intake
from . import fixtures as fx, sql
from .registry import query


@query("clean_text", f"SELECT doc_id, {sql.clean('text')} AS text FROM documents")
def clean_text(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", clean("text").alias("text"))


def _spans_sql(kind):
    return f"""WITH t AS (SELECT doc_id, {sql.clean('text')} AS t FROM documents), l AS (SELECT doc_id, {sql.spans('t', kind)} AS l FROM t)
      SELECT doc_id, unnest(l) AS term FROM l"""


@query("quoted_terms", _spans_sql("quoted"))
def quoted_terms(spark, sf):
    return op.quoted_terms(fx.table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "term")


@query("question_terms", f"""WITH src AS (SELECT 'document' AS origin, doc_id AS id, 0 AS turn, text FROM documents
      UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations),
    t AS (SELECT origin, id, turn, {sql.clean('text')} AS t FROM src), l AS (SELECT origin, id, turn, {sql.spans('t', 'question')} AS l FROM t)
    SELECT origin, id, turn, unnest(l) AS term FROM l""")
def question_terms(spark, sf):
    docs = fx.table(spark, sf, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text"
    )
    asked = fx.table(spark, sf, "conversations")
    turns = asked.select(F.lit("turn").alias("origin"), F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"), "text")
    return op.question_terms(docs.unionByName(turns), "text").select("origin", "id", "turn", "term")


@query("entity_spans", f"""WITH t AS (SELECT doc_id, {sql.clean('text')} AS t FROM documents), l AS (SELECT doc_id, {sql.spans('t', 'entity')} AS l FROM t)
    SELECT doc_id, term, count(*) AS term_count FROM (SELECT doc_id, unnest(l) AS term FROM l) GROUP BY ALL""")
def entity_spans(spark, sf):
    return op.entity_terms(fx.table(spark, sf, "documents"), "text", "doc_id").select("doc_id", "term", "term_count")


@query("title_terms", f"WITH {sql.PARSED} SELECT page_id, title AS term, 'page_title' AS term_type, 'title' AS extraction_method FROM parsed WHERE title <> ''")
def title_terms(spark, sf):
    return op.title_terms(fx.corpus(spark, sf), "page_id")


@query("heading_terms", f"""WITH {sql.PAGES_PLUS}, m AS (SELECT page_id, {sql.markup('html')} AS m FROM pages_plus),
    h AS (SELECT page_id, {sql.heading_list(sql.headings('m', 1))} AS l1, {sql.heading_list(sql.headings('m', 2))} AS l2,
      {sql.heading_list(sql.headings('m', 3))} AS l3 FROM m)
    SELECT page_id, term, term_type, extraction_method FROM ({sql.occurrences('h', 'page_id', [(1, 'l1', 'heading', 'h1'),
      (2, 'l2', 'heading', 'h2'), (3, 'l3', 'heading', 'h3')])}) WHERE term <> ''""")
def heading_terms(spark, sf):
    from ..operators.pages import parse_pages

    return op.heading_terms(parse_pages(fx.pages_plus(spark, sf)), "page_id").drop("pos")


@query("mine_pages", f"WITH {sql.CORPUS_CANDIDATES} SELECT * FROM page_cand")
def mine_pages(spark, sf):
    return op.mine_pages(fx.corpus(spark, sf), "page_id")


@query("mine_entities", f"WITH {sql.ENTITY_CANDIDATES} SELECT * FROM ent_cand")
def mine_entities(spark, sf):
    return op.mine_entities(fx.entities(spark, sf), "doc_id")


@query("collapse_terms", """SELECT p_name AS term, 'https://p.example/' || min_key AS source_url, 'part' AS source_entity_type, min_key::VARCHAR AS source_entity_id,
    '' AS lang, 'book_title' AS term_type, n AS term_count, '' AS source_title, 'name' AS extraction_method
    FROM (SELECT CASE WHEN min(p_partkey) % 2 = 1 THEN upper(p_name) ELSE p_name END AS p_name, min(p_partkey) AS min_key, sum(p_size)::BIGINT AS n FROM part GROUP BY part.p_name)""")
def collapse_terms(spark, sf):
    part = fx.table(spark, sf, "part")
    key, nothing = F.col("p_partkey").cast("string"), F.lit("")
    rows = part.select(
        F.when(F.col("p_partkey") % 2 == 1, F.upper("p_name")).otherwise(F.col("p_name")).alias("term"),
        F.concat(F.lit("https://p.example/"), key).alias("source_url"),
        F.lit("part").alias("source_entity_type"), key.alias("source_entity_id"), nothing.alias("lang"),
        F.lit("book_title").alias("term_type"), F.col("p_size").cast("bigint").alias("term_count"), nothing.alias("source_title"),
        F.lit("name").alias("extraction_method"), F.col("p_partkey").alias("ord"),
    )
    return op.collapse_terms(rows)


@query("union_candidates", f"WITH {sql.CANDIDATES} SELECT * FROM cand")
def union_candidates(spark, sf):
    return fx.candidates(spark, sf)


@query("table_roundtrip", f"WITH {sql.CANDIDATES} SELECT * FROM cand")
def table_roundtrip(spark, sf):
    folder = new_folder(spark, "candidates")
    tables.write_table(fx.candidates(spark, sf), folder)
    return tables.read_table(spark, folder, CANDIDATES)


@query("term_type_counts", f"WITH {sql.CANDIDATES} SELECT term_type, count(*) AS terms FROM cand GROUP BY 1")
def term_type_counts(spark, sf):
    return op.term_type_counts(fx.candidates(spark, sf))


# compressed documents whose phrases one task sends, and counts
SENT_BYTES, PHRASE_BYTES = 8 << 20, 4 << 20
STOPS = sql.texts(sql.LANGUAGES["en"].stopwords)


@query("repeated_phrases", f"""WITH l AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(text), '[^{sql.W}''’]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
      FROM documents),
    w AS (SELECT doc_id, unnest(w) AS w1, unnest(range(len(w))) AS i FROM l),
    n AS (SELECT doc_id, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    k AS (SELECT DISTINCT doc_id, unnest([
        CASE WHEN w2 IS NOT NULL AND NOT list_contains({STOPS}, w2) THEN w1 || ' ' || w2 END,
        CASE WHEN w3 IS NOT NULL AND NOT list_contains({STOPS}, w3) THEN w1 || ' ' || w2 || ' ' || w3 END,
        CASE WHEN w4 IS NOT NULL AND NOT list_contains({STOPS}, w4) THEN w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END]) AS term
      FROM n WHERE NOT list_contains({STOPS}, w1))
    SELECT term, 'noun_phrase' AS term_type, count(*) AS doc_count, 'repeated_phrase' AS extraction_method FROM k WHERE term IS NOT NULL GROUP BY term HAVING count(*) >= 2""")
def repeated_phrases(spark, sf):
    """Small parts: a task counts the phrases of few documents, so that its table of them fits its memory."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return op.repeated_phrases(tables.spread_by_size(docs, SENT_BYTES), "text", "lang", parts=tables.parts_by_size(docs, PHRASE_BYTES))


PRIORITY = """CASE term_type WHEN 'book_title' THEN 0 WHEN 'author' THEN 1 WHEN 'page_title' THEN 2 WHEN 'character' THEN 3 WHEN 'heading' THEN 4
    WHEN 'question_phrase' THEN 5 ELSE 9 END"""
SELECTED = f"""{sql.CANDIDATES}, keyed AS (SELECT *, {PRIORITY} AS pr, {sql.strip('lower(term)')} AS lc FROM cand),
  firsts AS (SELECT *, row_number() OVER (PARTITION BY lc ORDER BY pr, term_count DESC, term, source_url, source_entity_id, term_type) AS rn FROM keyed),
  selected AS (SELECT *, row_number() OVER (ORDER BY pr, term_count DESC, term, source_url, source_entity_id, term_type) - 1 AS idx FROM firsts WHERE rn = 1)"""
LIMIT = 250


@query("select_terms", f"WITH {SELECTED} SELECT {sql.CANDIDATE_COLUMNS} FROM selected WHERE idx < {LIMIT}")
def select_terms(spark, sf):
    """The term limit is the operator's own parameter."""
    return planning.select_terms(fx.candidates(spark, sf), LIMIT)


@query("unique_keywords", f"WITH {sql.DISC} SELECT DISTINCT trim(keyword) AS keyword FROM disc WHERE trim(keyword) <> ''")
def unique_keywords(spark, sf):
    return planning.unique_keywords(fx.disc(spark, sf))


@query("request_batches", f"""WITH {sql.DISC}, k AS (SELECT DISTINCT trim(keyword) AS keyword FROM disc), i AS (SELECT keyword, row_number() OVER (ORDER BY keyword) - 1 AS idx FROM k)
    SELECT idx // 1000 AS batch, count(*) AS n, string_agg(keyword, '|' ORDER BY idx) AS items FROM i GROUP BY 1""")
def request_batches(spark, sf):
    batches = planning.plan_batches(planning.unique_keywords(fx.disc(spark, sf)), "keyword", 1000)
    return batches.select("batch", F.col("n").cast("bigint").alias("n"), F.array_join("items", "|").alias("items"))


PLAN = f"""{SELECTED}, plan_terms AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM selected WHERE idx < {LIMIT}),
  plan AS (SELECT idx * 2 AS call_idx, 'keyword_suggestions' AS endpoint, term AS subject, 1::BIGINT AS n_terms FROM plan_terms
    UNION ALL SELECT idx * 2 + 1, 'related_keywords', term, 1 FROM plan_terms
    UNION ALL SELECT count(*) * 2, 'keyword_ideas', '<batch>', least(count(*), {IDEAS_TERMS}) FROM plan_terms
    UNION ALL SELECT count(*) * 2 + 1, 'keywords_for_site', 'site:one.example', 0 FROM plan_terms
    UNION ALL SELECT count(*) * 2 + 2, 'keywords_for_site', 'site:two.example', 0 FROM plan_terms)"""


def _plan(spark, sf):
    terms = planning.select_terms(fx.candidates(spark, sf), LIMIT)
    return planning.plan_discovery(terms, ("one.example", "two.example"), "term")


@query("discovery_plan", f"WITH {PLAN} SELECT * FROM plan")
def discovery_plan(spark, sf):
    return _plan(spark, sf)


@query("call_budget", f"WITH {PLAN} SELECT *, call_idx < 200 AS planned FROM plan")
def call_budget(spark, sf):
    return planning.cap_calls(_plan(spark, sf), 200)


@query("uncached_requests", f"WITH {PLAN} SELECT * FROM plan WHERE call_idx % 3 = 0 AND endpoint <> 'keyword_ideas'")
def uncached_requests(spark, sf):
    """Two calls in three, of all four kinds, have a response in a written log of that month, the others one of another month."""
    terms = stage(planning.select_terms(fx.candidates(spark, sf), LIMIT), "terms")
    plan = stage(planning.plan_discovery(terms, ("one.example", "two.example"), "term"), "plan")
    several = terms.orderBy("term").limit(IDEAS_TERMS).agg(F.collect_list("term")).scalar()
    kind = F.col("endpoint")
    request = F.struct(
        F.when(kind.isin("keyword_suggestions", "related_keywords"), F.col("subject")).alias("keyword"),
        F.when(kind == "keyword_ideas", F.reverse(several)).alias("keywords"),
        F.when(kind == "keywords_for_site", F.substring("subject", 6, 1000)).alias("target"),
        F.lit(2840).alias("location_code"), F.lit(None).cast("string").alias("language_code"),
    )
    answered = (F.col("call_idx") % 3 != 0) | (kind == "keyword_ideas")
    envelope = F.struct(
        F.concat(F.lit("/v3/labs/"), kind, F.lit("/live")).alias("endpoint"), F.array(request).alias("request"),
        F.struct(F.lit(20000).alias("status_code")).alias("response"),
        F.when(answered, "2024-01-31T23:00:00Z").otherwise("2024-02-01T01:00:00Z").alias("collected_at"),
    )
    log = new_folder(spark, "log")
    raw_io.append_raw(raw_io.parse_raw(plan.select(F.to_json(envelope).alias("value"))), log)
    logged = intake.reuse_key(raw_io.read_raw(spark, log, logs=KNOWN_LOGS))
    keyed = planning.with_reuse_key(plan, terms, "term", location_code=2840, language_code=None, bucket="2024-01")
    return planning.without_logged(keyed, logged).select("call_idx", "endpoint", "subject", "n_terms")
