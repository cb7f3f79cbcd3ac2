"""Ten keywords with scores worked out by hand from the rules."""

import pytest
from pyspark.sql import functions as F

from termtide.config import ActionRule, ScoringConfig
from termtide.operators import containment, merge, report, score as sc, terms
from termtide.plans.stages import keyword_opportunities
from termtide.schemas import EXPORT_COLUMNS, PAGES
from termtide.sources.tables import export_opportunities

PAGE_TEXTS = [
    ("https://site.example/contest?id=1", "Ten questions on a tragedy", "Ten questions", "Prince Hamlet is the hero. \"Hamlet\" is a play. Who killed King Hamlet?"),
    ("https://site.example/chat?id=2", "Talk to a detective", "Sherlock Holmes chat", "Sherlock Holmes is a detective. What is deduction?"),
    ("https://site.example/read?id=5", "A novel explained", "The Great Gatsby", "\"The Great Gatsby\" is a novel. Explain the ending of The Great Gatsby."),
]

KEYWORDS = [
    ("hamlet quiz", 2400, 0.18), ("hamlet summary", 8100, 0.09), ("why did hamlet delay revenge", 320, 0.04), ("sherlock holmes chat", 590, 0.30),
    ("sherlock holmes deduction", 480, 0.22), ("the great gatsby summary", 40500, 0.45), ("great gatsby characters", 12100, 0.35),
    ("buy the great gatsby cheap", 1600, 0.95), ("great gatsby free pdf download", 5400, 0.88), ("quiz games online", 27100, 0.60),
]

# keyword, relevance, question, opportunity, intent, cluster, content, action, passes
GOLDEN = [
    ("hamlet summary", 1.0, 0.7, 0.7489, "educational", "hamlet", True, "add_faq_to_existing_page", True),
    ("the great gatsby summary", 1.0, 0.7, 0.73, "educational", "the great gatsby", True, "add_faq_to_existing_page", True),
    ("hamlet quiz", 0.9, 0.4, 0.6408, "quiz_game", "hamlet", True, "add_faq_to_existing_page", True),
    ("why did hamlet delay revenge", 0.7, 0.6, 0.5824, "informational", "hamlet", True, "create_quiz", True),
    ("sherlock holmes chat", 0.9, 0.4, 0.5705, "chat_character", "sherlock holmes", True, "create_quiz", True),
    ("great gatsby characters", 0.3, 0.4, 0.5401, "chat_character", "great", False, "monitor_only", True),
    ("quiz games online", 0.3, 0.4, 0.5167, "quiz_game", "quiz", False, "monitor_only", True),
    ("sherlock holmes deduction", 0.6, 0.0, 0.4797, "other", "sherlock holmes", True, "create_quiz", True),
    ("buy the great gatsby cheap", 0.6, 0.0, 0.112, "commercial", "the great gatsby", True, "create_quiz", False),
    ("great gatsby free pdf download", 0.0, 0.0, 0.0, "commercial", "great", False, "ignore_irrelevant", False),
]


@pytest.fixture(scope="module")
def candidates(spark):
    rows = [
        (u, "en", t, "", h, "", "", b, "page", "", "", "", [], None) for u, t, h, b in PAGE_TEXTS
    ]
    return terms.mine_pages(spark.createDataFrame(rows, PAGES)).cache()


@pytest.fixture(scope="module")
def discovered(spark):
    rows = [(i, k, "seed", "keyword_suggestions", 2840, "en", v, 0.1, c, "LOW", None, "") for i, (k, v, c) in enumerate(KEYWORDS)]
    ddl = ("ord bigint, keyword string, source_term string, source_endpoint string, location_code int, language_code string, search_volume bigint, "
           "cpc double, competition double, competition_level string, keyword_difficulty double, categories string")
    return spark.createDataFrame(rows, ddl)


@pytest.fixture(scope="module")
def ranked(discovered, candidates):
    return keyword_opportunities(discovered, None, candidates, order="ord").cache()


def test_golden_rows(ranked):
    rows = ranked.select(
        "keyword", "relevance_score", "question_intent_score", "opportunity_score", "intent_label", "cluster_label", "content_available",
        "recommended_action", "passes_filters",
    ).collect()
    assert [tuple(r) for r in rows] == GOLDEN


def test_sentence_starts_and_spans_are_entities(candidates):
    names = {r.term for r in candidates.where("term_type = 'character'").collect()}
    assert {"Prince Hamlet", "King Hamlet", "What", "Explain", "The Great Gatsby"} <= names and "Who" not in names


def test_reports(ranked):
    assert tuple(report.summary_totals(ranked).first()) == (10, 10, 8)
    assert [r.cluster_label for r in report.cluster_summary(ranked).collect()][0] == "the great gatsby"
    assert report.top_opportunities(ranked, 3).columns == list(EXPORT_COLUMNS)
    top = report.top_clusters(ranked).first()
    assert (top.cluster_label, top.keywords) == ("hamlet", 3)
    out = export_opportunities(ranked.drop("cpc", "source_urls"))
    assert out.columns == list(EXPORT_COLUMNS) and out.where("cpc is not null or source_urls is not null").count() == 0


def test_every_row_has_one_action_and_scores_stay_in_range(spark, sf):
    from termtide.catalog.keyword_queries import scored

    rows = scored(spark, sf)
    actions = {"create_landing_page", "add_faq_to_existing_page", "create_chat", "create_quiz", "improve_title_meta", "monitor_only", "ignore_irrelevant"}
    bad = rows.where(
        ~F.col("recommended_action").isin(*actions) | F.col("recommended_action").isNull()
        | ~F.col("opportunity_score").between(0, 1) | ~F.col("relevance_score").between(0, 1) | ~F.col("question_intent_score").between(0, 1)
    )
    assert bad.count() == 0


def test_rules_that_are_not_known_are_skipped(ranked):
    rules = (ActionRule("evil", "java_method('x', 'y')"), ActionRule("unknown", "nothing > 1"), ActionRule("null", "search_volume / 0 > 1 and False"),
             ActionRule("big", "search_volume >= 10000 and not content_available"))
    chains = (ActionRule("by zero", "opportunity_score / (search_volume - search_volume) >= 1"), ActionRule("cut off", "opportunity_score >="),
              ActionRule("never", "2 < opportunity_score < 3"))
    cfg = ScoringConfig(actions=rules[:3] + chains + rules[3:])
    rows = sc.recommend_action(ranked.withColumn("d", F.lit(False)), "d", cfg)
    assert {r.keyword for r in rows.where("recommended_action = 'big'").collect()} == {"great gatsby characters", "quiz games online"}
    assert rows.where("recommended_action = 'monitor_only'").count() == 8


def test_empty_inputs_keep_the_schema(spark, discovered, candidates):
    none = keyword_opportunities(discovered.where("false"), None, candidates, order="ord")
    assert none.count() == 0 and "opportunity_score" in none.columns and "monthly_searches" in none.columns
    no_entities = keyword_opportunities(discovered, None, None, order="ord")
    assert no_entities.where("content_available").count() == 0


def test_merge_handles_null_markets_and_blank_keywords(spark):
    ddl = ("ord bigint, keyword string, source_term string, source_endpoint string, location_code int, language_code string, search_volume bigint, "
           "cpc double, competition double, competition_level string, keyword_difficulty double, categories string, source_url string")
    rows = [
        (2, "Red  ring!", " b ", "e", None, None, 5, 0.1, float("nan"), None, None, "x", "u2|u1"),
        (1, "red ring", "a", "e", None, None, 7, None, 0.2, None, 3.0, "", "u1"),
        (3, "RED RING", "a", "f", None, None, None, 0.3, None, "LOW", None, None, None),
        (4, "!!!", "a", "e", None, None, 1, 1.0, 1.0, "LOW", 1.0, "x", ""),
        (5, "red ring", "a", "e", 1, "en", 1, 1.0, 1.0, "LOW", 1.0, "x", ""),
    ]
    disc = spark.createDataFrame(rows, ddl)
    metrics = spark.createDataFrame(
        [("RED ring", None, None, 70, 0.5, "2024-01-02"), ("red ring", None, None, 99, 0.6, "2024-01-03")],
        "keyword string, location_code int, language_code string, search_volume bigint, trend_3m double, collected_at string",
    )
    out = {r.location_code: r for r in merge.merge_keywords(disc, metrics, "ord").collect()}
    assert set(out) == {None, 1}
    r = out[None]
    assert (r.keyword, r.search_volume, r.cpc, r.competition, r.competition_level, r.keyword_difficulty) == ("red ring", 70.0, 0.3, 0.2, "LOW", 3.0)
    assert (r.source_terms, r.source_endpoints, r.categories, r.source_urls, r.trend_3m) == ("a|b", "e|f", "x", "u1|u2", 0.5)
    assert out[1].search_volume == 1.0 and out[1].trend_3m is None and out[1].keyword_id != r.keyword_id


def test_entity_ties_and_short_terms(spark):
    cand = spark.createDataFrame(
        [("Abc", "author"), ("abd ", "character"), ("ab", "author"), ("zzz", "heading"), (None, "author")], "term string, term_type string"
    )
    known = containment.entity_set(cand)
    assert sorted(r.entity for r in known.collect()) == ["abc", "abd"]
    kw = spark.createDataFrame([("x ABD abc",), ("none",), ("",), (None,)], "keyword string")
    got = {r.keyword: r.entity for r in containment.with_longest_entity(kw, known).collect()}
    assert got == {"x ABD abc": "abc", "none": None, "": None, None: None}
