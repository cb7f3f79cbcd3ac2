"""Page corpus: parsing, link edges, seeds, bounded reachability, url policy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import CrawlLimits
from ..functions import web
from ..session import buckets
from .spread import lookup_join, with_index

ID_CHUNK = 10_000


def parse_pages(pages: DataFrame) -> DataFrame:
    """Parse ``pages(url, html, ..)`` into the page contract in one projection.

    Other columns pass through. The canonical url replaces ``url``; type, ids and
    links still come from the url the page was fetched by.
    """
    rest = [c for c in pages.columns if c not in ("url", "html", "created_at")]
    created = F.col("created_at") if "created_at" in pages.columns else F.lit(None).cast("timestamp")
    prepared = pages.withColumn("_markup", web.markup("html"))
    ids = web.page_ids("url")
    return prepared.select(
        *rest,
        web.canonical_url("url", "_markup").alias("url"),
        web.page_lang("_markup").alias("lang"),
        web.page_title("_markup").alias("title"),
        web.page_meta("_markup").alias("meta_description"),
        *[web.page_headings("_markup", level).alias(f"h{level}") for level in (1, 2, 3)],
        web.main_text("html").alias("body_text"),
        web.content_type("url").alias("content_type"),
        *[ids[name].alias(name) for name in ("course_id", "reading_id", "echo_id")],
        web.internal_links("url", "_markup").alias("internal_links"),
        created.alias("created_at"),
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """One row per (page url, internal link)."""
    links = web.internal_links("url", web.markup("html"))
    return pages.select(F.col("url").alias("src"), F.explode(links).alias("dst"))


def seed_urls(sites: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Start urls of each site: its base url, then every pattern for every id.

    ``sites(base_url, id_start, id_end)``; a null range means no id probing.
    """
    probed = sites.where(F.col("id_start") <= F.col("id_end"))
    # two steps, so that no array grows with the width of the id range
    chunks = probed.withColumn("_from", F.explode(F.sequence("id_start", "id_end", F.lit(ID_CHUNK).cast("bigint"))))
    ids = chunks.withColumn(
        "_id", F.explode(F.sequence("_from", F.least(F.col("_from") + (ID_CHUNK - 1), F.col("id_end"))))
    )
    urls = F.transform(
        F.array(*[F.lit(p) for p in patterns]),
        lambda p: web.resolve_url(web.url_parts("base_url"), F.replace(p, F.lit("{id}"), F.col("_id").cast("string"))),
    )
    generated = ids.select("base_url", F.explode(urls).alias("url"))
    return sites.select("base_url", F.col("base_url").alias("url")).unionByName(generated)


def reachable_pages(
    pages: DataFrame,
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int = CrawlLimits.max_depth,
    max_pages: int | None = CrawlLimits.max_pages,
    hosts: Sequence[str] | None = None,
) -> DataFrame:
    """Breadth-first visit of ``pages(url)`` over ``edges(src, dst)`` from ``seeds(url, ord)``.

    First in, first out: rows (url, depth, ``visit_rank``) are ordered by depth, rank of
    the first page that links there, link; ``max_pages`` ends the visit after that many.
    Given ``hosts``, only their urls are visited. Null urls and repeated rows count for nothing.

    Pages, distinct edges (of which a page has no more than its text holds) and what is
    visited are tables bucketed by url. A level's links are found without a shuffle of
    edges, and only what they link to is shuffled to be held against pages and visited urls.
    """
    with buckets(pages.sparkSession) as tables:
        wanted = pages.where(F.col("url").isNotNull())
        if hosts is not None:
            wanted = wanted.where(web.url_part("url", "host").isin(*hosts))
        known, _ = tables.write(wanted.select("url").distinct(), "pages", "url")
        graph, _ = tables.write(edges.select("src", "dst").where("src <> dst").distinct(), "edges", "src")
        order: list[Column] = [F.col("parent_rank"), F.col("url")]
        visited: list[DataFrame] = []
        levels: list[DataFrame] = []
        taken = 0
        for depth in range(max_depth + 1):
            found = linked_from(graph, levels[-1]) if levels else seeds.groupBy("url").agg(F.min("ord").alias("parent_rank"))
            queue = unvisited(found, known, visited)
            if max_pages is not None:
                queue = queue.orderBy(*order).limit(max_pages - taken)
            bucketed, plain = tables.write(queue, "level", "url")
            visited.append(bucketed)
            ranked = with_index(plain, *order, name="_rank")
            levels.append(ranked.select("url", F.lit(depth).alias("depth"), (F.col("_rank") + taken).alias("visit_rank")))
            if depth < max_depth:
                size = plain.count()
                taken += size
                if size == 0 or taken == max_pages:
                    break
    return reduce(DataFrame.unionByName, levels)


def linked_from(edges: DataFrame, level: DataFrame) -> DataFrame:
    """Urls that pages of a level link to, with the smallest rank of such a page."""
    ranks = level.select(F.col("url").alias("src"), "visit_rank")
    return edges.join(ranks, "src").groupBy(F.col("dst").alias("url")).agg(F.min("visit_rank").alias("parent_rank"))


def unvisited(found: DataFrame, known: DataFrame, visited: Sequence[DataFrame]) -> DataFrame:
    """Those of ``found`` that are pages and in no earlier level."""
    left = found.join(known, "url", "left_semi")
    for urls in visited:
        left = left.join(urls, "url", "left_anti")
    return left


def apply_url_policy(urls: DataFrame, rules: DataFrame, agent: str = "*") -> DataFrame:
    """Add ``allowed`` to ``urls(url, ..)``: the longest rule prefix of its host decides.

    ``rules(host, agent, path_prefix, allow)``. Rules for the agent itself replace
    the host's '*' rules; equal prefixes that disagree allow; no rule allows.
    """
    own = F.col("agent") == agent
    usable = rules.where(own | (F.col("agent") == "*"))
    per_prefix = usable.groupBy("host", own.alias("own"), "path_prefix").agg(F.max("allow").alias("allow"))
    # a host's lengths of prefixes are few, however many prefixes it has
    hosts = per_prefix.groupBy("host").agg(
        F.max("own").alias("own"),
        F.collect_set(F.when(F.col("own"), F.length("path_prefix"))).alias("_own"),
        F.collect_set(F.when(~F.col("own"), F.length("path_prefix"))).alias("_any"),
    )
    lengths = hosts.select("host", "own", F.when(F.col("own"), F.col("_own")).otherwise(F.col("_any")).alias("_lengths"))
    query = web.url_part("url", "query")
    target = F.concat(web.url_part("url", "path"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    located = urls.withColumns({"host": web.url_part("url", "host"), "_target": target})
    # beginnings of those lengths look up the host's rules
    tried = lookup_join(located.select("host", "_target").distinct(), lengths, on=["host"], how="inner").select(
        "host", "_target", "own", F.explode(F.filter("_lengths", lambda n: n <= F.length("_target"))).alias("_length")
    )
    keyed = tried.withColumn("path_prefix", F.col("_target").substr(F.lit(1), F.col("_length")))
    hits = lookup_join(keyed, per_prefix, on=["host", "own", "path_prefix"], how="inner")
    # one number of length and verdict: the longest decides
    longest = hits.groupBy("host", "_target").agg(F.max(F.col("_length") * 2 + F.col("allow").cast("int")).alias("_verdict"))
    judged = lookup_join(located, longest, on=["host", "_target"])
    return judged.withColumn("allowed", F.coalesce(F.col("_verdict") % 2 == 1, F.lit(True))).select(*located.columns, "allowed").drop("_target")
