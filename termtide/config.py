"""Settings as plain dataclasses; the defaults are the contract's values."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Market:
    key: str
    name: str
    location_code: int
    language_code: str


# Markets.
MARKETS = (
    Market("us-en", "United States", 2840, "en"),
    Market("uk-en", "United Kingdom", 2826, "en"),
    Market("il-en", "Israel (English)", 2376, "en"),
    Market("il-ru", "Israel (Russian)", 2376, "ru"),
    Market("ru-ru", "Russia", 2643, "ru"),
)
DEFAULT_MARKET = "us-en"


@dataclass(frozen=True)
class LanguageSignals:
    question_words: tuple[str, ...]
    intent_signals: tuple[str, ...]
    stopwords: tuple[str, ...]


# Word lists per language; a language without a list uses 'en'.
FALLBACK_LANGUAGE = "en"
LANGUAGES = {
    "en": LanguageSignals(
        question_words=(
            "why", "how", "who", "what", "when", "where", "did", "is", "was", "explain", "summary", "meaning",
        ),
        intent_signals=(
            "quiz", "test", "chat", "character", "conversation", "summary", "explained", "questions",
            "answers", "characters", "biography", "timeline", "analysis", "facts",
        ),
        stopwords=(
            "the", "a", "an", "of", "and", "to", "in", "for", "on", "with", "is", "are", "this", "that",
        ),
    ),
    "ru": LanguageSignals(
        question_words=(
            "почему", "как", "кто", "что", "когда", "где", "объяснение", "кратко", "смысл", "значение",
        ),
        intent_signals=(
            "викторина", "тест", "персонаж", "разговор", "краткое", "содержание", "вопросы", "ответы",
            "биография", "анализ", "факты",
        ),
        stopwords=("и", "в", "на", "с", "по", "для", "это", "как", "что", "а"),
    ),
}

# Intent labels in order of precedence. The first-token question
# test stands between 'educational' and 'commercial'.
INTENT_WORDS = {
    "quiz_game": ("quiz", "test", "викторина", "тест"),
    "chat_character": ("chat", "conversation", "разговор", "character", "персонаж"),
    "educational": ("summary", "explained", "analysis", "краткое", "анализ", "содержание"),
    "commercial": ("buy", "price", "cheap", "download", "купить", "скачать"),
}

# Result element types that decide the intent of a result page.
SERP_INTENTS = (
    ("commercial", ("shopping", "product_information", "commercial_units", "paid")),
    ("informational", ("people_also_ask", "featured_snippet", "answer_box", "knowledge_graph")),
    ("video", ("video", "youtube")),
    ("local", ("local_pack", "map", "hotels_pack")),
)
SERP_INTENT_OTHER = "navigational_or_mixed"

# Order in which term types are worth a request.
TYPE_PRIORITY = {
    "book_title": 0,
    "author": 1,
    "page_title": 2,
    "character": 3,
    "historical_person": 3,
    "heading": 4,
    "question_phrase": 5,
    "noun_phrase": 6,
    "site_keyword": 6,
}
LOWEST_PRIORITY = 9

# Term types that name known entities.
ENTITY_TYPES = ("book_title", "author", "character", "historical_person", "page_title")


@dataclass(frozen=True)
class Weights:
    search_volume_log: float = 0.35
    low_competition: float = 0.20
    trend_growth: float = 0.15
    relevance: float = 0.20
    question_intent: float = 0.10


@dataclass(frozen=True)
class Filters:
    min_search_volume: float = 20
    max_competition: float = 0.8


@dataclass(frozen=True)
class NegativeCategory:
    name: str
    patterns: tuple[str, ...]
    enabled: bool = True
    drop: bool = False


@dataclass(frozen=True)
class ActionRule:
    action: str
    when: str


NEGATIVE_CATEGORIES = (
    NegativeCategory("adult", ("porn", "xxx", "nude", "sex"), drop=True),
    NegativeCategory("piracy", ("download", "torrent", "free pdf", "epub download", "pirate"), drop=True),
    NegativeCategory("explicit_political_targeting", ()),
    NegativeCategory("unrelated_commercial", ("buy", "cheap", "discount", "coupon", "for sale", "price")),
)
DOWNRANK = 0.3

ACTION_RULES = (
    ActionRule("create_landing_page", "opportunity_score >= 0.75 and content_available == False"),
    ActionRule("add_faq_to_existing_page", "opportunity_score >= 0.6 and content_available == True"),
    ActionRule("create_chat", "question_intent_score >= 0.6 and content_available == False"),
    ActionRule("create_quiz", "relevance_score >= 0.6 and search_volume >= 100"),
    ActionRule("improve_title_meta", "content_available == True and opportunity_score >= 0.4"),
    ActionRule("monitor_only", "opportunity_score >= 0.2"),
    ActionRule("ignore_irrelevant", "True"),
)
DROPPED_ACTION = "ignore_irrelevant"
UNMATCHED_ACTION = "monitor_only"


@dataclass(frozen=True)
class ScoringConfig:
    filters: Filters = field(default_factory=Filters)
    weights: Weights = field(default_factory=Weights)
    negatives: tuple[NegativeCategory, ...] = NEGATIVE_CATEGORIES
    actions: tuple[ActionRule, ...] = ACTION_RULES
    languages: dict[str, LanguageSignals] = field(default_factory=lambda: dict(LANGUAGES))
    clustering: str = "lexical"
    max_clusters: int = 12


DEFAULT_SCORING = ScoringConfig()


@dataclass(frozen=True)
class CrawlLimits:
    max_pages: int = 200
    max_depth: int = 2


# Limits of the request contract.
VOLUME_BATCH = 1000
TRENDS_BATCH = 5
IDEAS_TERMS = 200

# The calls a single term gets, in order; those for several terms and for sites; the logs known by them.
TERM_ENDPOINTS = ("keyword_suggestions", "related_keywords")
IDEAS_ENDPOINT = "keyword_ideas"
SITE_ENDPOINT = "keywords_for_site"
KNOWN_LOGS = (*TERM_ENDPOINTS, IDEAS_ENDPOINT, SITE_ENDPOINT)
MAX_CALLS = 200
SERP_SHORTLIST = 25
TRENDS_SHORTLIST = 50
REPORT_TOP = 20
REPORT_ROWS = 500


def resolve_market(key: str | None = None) -> Market:
    """Market of a key, the default one without a key; an unknown key is an error."""
    wanted = key or DEFAULT_MARKET
    by_key = {m.key: m for m in MARKETS}
    if wanted not in by_key:
        raise KeyError(f"unknown market {wanted!r}; known markets: {', '.join(by_key)}")
    return by_key[wanted]
