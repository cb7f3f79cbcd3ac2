"""Scores and labels of a keyword as column expressions; components stay unrounded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from ..config import DOWNRANK, FALLBACK_LANGUAGE, INTENT_WORDS, LanguageSignals, NegativeCategory, Weights
from .text import as_column, contains_any, first_long_token, first_token

Languages = Mapping[str, LanguageSignals]


def _by_language(language: Column | str, languages: Languages, make) -> Column:
    """An expression per configured language; unknown and null languages take the fallback."""
    code = F.substring(as_column(language), 1, 2)
    out = make(languages[FALLBACK_LANGUAGE])
    for name, signals in languages.items():
        if name != FALLBACK_LANGUAGE:
            out = F.when(code == name, make(signals)).otherwise(out)
    return out


def signal_language(language: Column | str, languages: Languages) -> Column:
    code = F.substring(as_column(language), 1, 2)
    return F.when(code.isin(*languages), code).otherwise(FALLBACK_LANGUAGE)


def has_intent_signal(kw: Column, language: Column | str, languages: Languages) -> Column:
    return _by_language(language, languages, lambda s: contains_any(kw, s.intent_signals))


def has_question_word(kw: Column, language: Column | str, languages: Languages) -> Column:
    return _by_language(language, languages, lambda s: contains_any(kw, s.question_words))


def starts_as_question(kw: Column, language: Column | str, languages: Languages) -> Column:
    token = first_token(kw)
    return _by_language(language, languages, lambda s: token.isin(*s.question_words))


def _points(flag: Column, points: float) -> Column:
    return F.when(flag, F.lit(points)).otherwise(F.lit(0.0))


def relevance(kw: Column, entity_hit: Column, language: Column | str, languages: Languages) -> Column:
    total = (
        _points(entity_hit, 0.6)
        + _points(has_intent_signal(kw, language, languages), 0.3)
        + _points(has_question_word(kw, language, languages), 0.1)
    )
    return F.least(total, F.lit(1.0))


def question_intent(kw: Column, language: Column | str, languages: Languages) -> Column:
    asked = (
        F.when(starts_as_question(kw, language, languages), F.lit(0.6))
        .when(has_question_word(kw, language, languages), F.lit(0.3))
        .otherwise(F.lit(0.0))
    )
    return F.least(asked + _points(has_intent_signal(kw, language, languages), 0.4), F.lit(1.0))


def intent_label(kw: Column, language: Column | str, languages: Languages) -> Column:
    label = F.when(F.lit(False), "")
    for name in ("quiz_game", "chat_character", "educational"):
        label = label.when(contains_any(kw, INTENT_WORDS[name]), name)
    label = label.when(starts_as_question(kw, language, languages), "informational")
    return label.when(contains_any(kw, INTENT_WORDS["commercial"]), "commercial").otherwise("other")


def log_volume(volume: Column | str, largest: Column) -> Column:
    v = as_column(volume)
    scaled = F.log1p(v) / F.log1p(largest)
    return F.when((v > 0) & (largest > 0), scaled).otherwise(F.lit(0.0))


def _unit(c: Column) -> Column:
    return F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0))


def low_competition(competition: Column | str) -> Column:
    """Unknown competition counts as none, which is the best score."""
    return F.lit(1.0) - _unit(F.coalesce(as_column(competition), F.lit(0.0)))


def trend_score(trend: Column | str) -> Column:
    return _unit(F.coalesce(as_column(trend), F.lit(0.0)))


def negative_category(kw: Column, categories: Sequence[NegativeCategory]) -> Column:
    """Name of the first enabled category that matches, else NULL."""
    label = F.when(F.lit(False), "")
    for category in categories:
        if category.enabled and category.patterns:
            label = label.when(contains_any(kw, category.patterns), category.name)
    return label


def is_dropped(category: Column, categories: Sequence[NegativeCategory]) -> Column:
    dropping = [c.name for c in categories if c.drop]
    return F.coalesce(category.isin(*dropping), F.lit(False))


def negative_multiplier(category: Column, categories: Sequence[NegativeCategory]) -> Column:
    kept = F.when(category.isNull(), F.lit(1.0)).otherwise(F.lit(DOWNRANK))
    return F.when(is_dropped(category, categories), F.lit(0.0)).otherwise(kept)


def opportunity(parts: Mapping[str, Column], weights: Weights) -> Column:
    """Weighted sum of the five components, in the order of the weights."""
    return (
        F.lit(weights.search_volume_log) * parts["search_volume_log"]
        + F.lit(weights.low_competition) * parts["low_competition"]
        + F.lit(weights.trend_growth) * parts["trend_growth"]
        + F.lit(weights.relevance) * parts["relevance"]
        + F.lit(weights.question_intent) * parts["question_intent"]
    )


def lexical_cluster(kw: Column, entity: Column) -> Column:
    token = first_long_token(kw)
    return F.coalesce(entity, F.nullif(token, F.lit("")), F.lit("misc"))
