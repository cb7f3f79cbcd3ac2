"""The stages end to end: corpus to candidates, discoveries to ranked opportunities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT_SCORING, ScoringConfig
from ..operators import cluster, enrich, merge, report, responses, terms
from ..operators.score import rank_order, score
from ..schemas import SERP_ENVELOPE
from ..session import stage
from ..sources import raw as raw_io, tables
from ..sources.versions import read_current, write_version


def candidate_terms(pages: DataFrame | None, entities: DataFrame | None, page_order: str = "url", entity_order: str = "entity_id") -> DataFrame:
    """Candidates of the sources at hand; pages come before entities."""
    families = []
    if pages is not None:
        families.append(terms.mine_pages(pages, page_order))
    if entities is not None:
        families.append(terms.mine_entities(entities, entity_order))
    if not families:
        raise ValueError("no sources: neither pages nor entities")
    return terms.union_candidates(*families)


def keyword_opportunities(
    discovered: DataFrame,
    metrics: DataFrame | None = None,
    candidates: DataFrame | None = None,
    cfg: ScoringConfig = DEFAULT_SCORING,
    order: str = "collected_at",
) -> DataFrame:
    """Merge, score and rank; the merged master is written once and read from there."""
    master = stage(merge.merge_keywords(discovered, metrics, order), "master")
    scored = score(master, candidates, cfg)
    if cfg.clustering == "semantic":
        from ..operators.containment import entity_set

        entities = None if candidates is None else entity_set(candidates)
        scored = cluster.semantic_labels(stage(scored, "scored"), entities, "keyword_normalized", max_clusters=cfg.max_clusters)
    return scored.orderBy(*rank_order())


SERP_SHORTLIST, TREND_SHORTLIST = 25, 50


def refresh_serp(spark: SparkSession, master: str, log: str, n: int = SERP_SHORTLIST) -> DataFrame:
    """Merge logged result pages of the ``n`` best keywords into the versioned master table and write it again."""
    rows = read_current(spark, master)
    logged = raw_io.read_raw(spark, log, logs=responses.SERP_ENDPOINTS, shape=SERP_ENVELOPE)
    # pages of other keywords are left before their items are looked at
    asked = _asked_for(logged.withColumn("keyword", F.get("request", F.lit(0))["keyword"]), rows, n)
    write_version(enrich.attach_serp(rows, responses.flatten_serp(asked)), master)
    return read_current(spark, master)


def refresh_trends(spark: SparkSession, master: str, log: str, n: int = TREND_SHORTLIST) -> DataFrame:
    """Merge logged interest graphs of the ``n`` best keywords into the versioned master table and write it again."""
    rows = read_current(spark, master)
    found = responses.trend_table(raw_io.read_raw(spark, log))
    write_version(enrich.attach_trends(rows, _asked_for(found, rows, n)), master)
    return read_current(spark, master)


def _asked_for(found: DataFrame, master: DataFrame, n: int) -> DataFrame:
    return found.join(enrich.shortlist(master, n).distinct(), "keyword", "left_semi")


def report_tables(master: DataFrame) -> dict[str, DataFrame]:
    """Every table of the report, by name, from one scored master."""
    ranked = master.orderBy(*rank_order())
    return {
        "opportunities": tables.export_opportunities(ranked),
        "clusters": report.cluster_summary(master),
        "totals": report.summary_totals(master),
        "top_languages": report.top_languages(master),
        "top_clusters": report.top_clusters(master),
        "top_opportunities": report.top_opportunities(master),
        "volume_vs_competition": report.volume_vs_competition(master),
        "trend_matrix": report.trend_matrix(master),
        "markets": report.top_markets(master),
        "actions": report.action_report(master),
    }


def write_report(master: DataFrame, path: str) -> None:
    """The report of a scored master in one call: two files to hand on, and a table behind each of its figures."""
    master = stage(master, "report-master")
    for name, table in report_tables(master).items():
        if name in ("opportunities", "clusters"):
            tables.write_csv(table, f"{path}/{name}.csv")
        else:
            write_version(table, f"{path}/{name}")


def opportunities_by_cluster(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship run on the given tables."""
    from ..catalog import fixtures as fx

    mined = stage(candidate_terms(None, fx.entities(spark, sf), entity_order="doc_id"), "candidates")
    ranked = keyword_opportunities(fx.disc(spark, sf), fx.with_trends(fx.metrics(spark, sf)), mined, order="ord")
    return report.cluster_summary(ranked)
