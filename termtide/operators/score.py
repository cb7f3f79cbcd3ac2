"""The scoring stage: keyword master and known entities to ranked opportunities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULT_SCORING, DROPPED_ACTION, ScoringConfig
from ..functions import scoring
from ..functions.text import to_number
from ..plans.rules import compile_actions
from .containment import entity_set, with_longest_entity
from .spread import with_index

NUMERIC = ("search_volume", "competition", "trend_3m")


def coerce_numeric(df: DataFrame, columns=NUMERIC) -> DataFrame:
    """Numbers or null; absent columns come as null."""
    present = set(df.columns)
    return df.withColumns(
        {c: to_number(F.col(c).cast("string")) if c in present else F.lit(None).cast("double") for c in columns}
    )


def largest_volume(df: DataFrame) -> Column:
    """The largest volume of the whole table as a scalar subquery, 0 when there is none."""
    return F.coalesce(df.agg(F.max("search_volume")).scalar(), F.lit(0.0))


def passes_filters(dropped: Column, cfg: ScoringConfig = DEFAULT_SCORING) -> Column:
    enough = F.coalesce("search_volume", F.lit(0.0)) >= cfg.filters.min_search_volume
    open_field = F.coalesce("competition", F.lit(0.0)) <= cfg.filters.max_competition
    return enough & open_field & ~dropped


def rank_order() -> list[Column]:
    """Passing rows first, then by opportunity; ties in merge order."""
    ties = [F.col(c).asc_nulls_last() for c in ("keyword_normalized", "location_code", "language_code")]
    return [F.col("passes_filters").desc_nulls_last(), F.col("opportunity_score").desc_nulls_last(), *ties]


def rank_key() -> Column:
    """The rank order as one struct, smallest first, for min_by."""
    def last(c: str) -> list[Column]:
        return [F.col(c).isNull(), F.col(c)]

    keys = [~F.col("passes_filters"), -F.col("opportunity_score")]
    for c in ("keyword_normalized", "location_code", "language_code"):
        keys += last(c)
    return F.struct(*keys)


def rank_master(scored: DataFrame) -> DataFrame:
    """The master with its position in rank order, from 0."""
    return with_index(scored, *rank_order(), name="rank")


def score(
    master: DataFrame,
    candidates: DataFrame | None = None,
    cfg: ScoringConfig = DEFAULT_SCORING,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Add scores, labels, action and filter flag to every master row.

    Known entities come from the candidates or are given. The master is read three
    times (largest volume, distinct keywords, rows): pass a written stage table.
    """
    if entities is None and candidates is not None:
        entities = entity_set(candidates)
    rows = with_longest_entity(coerce_numeric(master), entities)
    kw, lang = F.lower(F.coalesce("keyword", F.lit(""))), F.col("language_code")
    hit = F.col("entity").isNotNull()
    category = scoring.negative_category(kw, cfg.negatives)
    parts = rows.withColumns(
        {
            "_relevance": scoring.relevance(kw, hit, lang, cfg.languages),
            "_question": scoring.question_intent(kw, lang, cfg.languages),
            "_category": category,
        }
    )
    dropped = scoring.is_dropped(F.col("_category"), cfg.negatives)
    total = scoring.opportunity(
        {
            "search_volume_log": scoring.log_volume("search_volume", largest_volume(coerce_numeric(master))),
            "low_competition": scoring.low_competition("competition"),
            "trend_growth": scoring.trend_score("trend_3m"),
            "relevance": F.col("_relevance"),
            "question_intent": F.col("_question"),
        },
        cfg.weights,
    )
    weighed = total * scoring.negative_multiplier(F.col("_category"), cfg.negatives)
    scored = parts.withColumns(
        {
            "relevance_score": F.bround("_relevance", 4),
            "question_intent_score": F.bround("_question", 4),
            "opportunity_score": F.bround(weighed, 4),
            "intent_label": scoring.intent_label(kw, lang, cfg.languages),
            "cluster_label": scoring.lexical_cluster(kw, F.col("entity")),
            "content_available": hit,
            "passes_filters": passes_filters(dropped, cfg),
            "_dropped": dropped,
        }
    )
    acted = recommend_action(scored, "_dropped", cfg)
    return acted.drop("_relevance", "_question", "_category", "_dropped", "entity")


def recommend_action(df: DataFrame, dropped: str, cfg: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    """Add the action of the first rule that holds; a missing volume counts as 0."""
    volume = F.coalesce("search_volume", F.lit(0.0))
    rows = df.withColumns({"_volume": F.col("search_volume"), "search_volume": volume})
    action = F.when(F.col(dropped), DROPPED_ACTION).otherwise(compile_actions(cfg.actions))
    named = rows.withColumn("recommended_action", action)
    return named.withColumn("search_volume", F.col("_volume")).drop("_volume")
