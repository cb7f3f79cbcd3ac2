"""Sources, page corpus, links, seeds, reachability, policy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import web
from ..operators import pages as op
from ..session import new_folder
from ..sources import tables
from . import fixtures as fx, sql
from .registry import query

JOINED = "array_join(internal_links, '|') AS internal_links"


@query("market_lookup", """SELECT o_orderkey, k AS market_key, CASE k WHEN 'us-en' THEN 'United States' WHEN 'uk-en' THEN 'United Kingdom'
    WHEN 'il-en' THEN 'Israel (English)' WHEN 'il-ru' THEN 'Israel (Russian)' WHEN 'ru-ru' THEN 'Russia' END AS name,
    CASE k WHEN 'us-en' THEN 2840 WHEN 'uk-en' THEN 2826 WHEN 'il-en' THEN 2376 WHEN 'il-ru' THEN 2376 WHEN 'ru-ru' THEN 2643 END AS location_code,
    CASE WHEN k IN ('us-en', 'uk-en', 'il-en') THEN 'en' WHEN k IN ('il-ru', 'ru-ru') THEN 'ru' END AS language_code
    FROM (SELECT o_orderkey, ['us-en', 'uk-en', 'il-en', 'il-ru', 'ru-ru', 'xx-xx'][(o_custkey % 6) + 1] AS k FROM orders)""")
def market_lookup(spark, sf):
    key = fx.pick(("us-en", "uk-en", "il-en", "il-ru", "ru-ru", "xx-xx"), F.col("o_custkey") % 6)
    return tables.lookup_market(fx.table(spark, sf, "orders").select("o_orderkey", key.alias("market_key")), "market_key")


@query("date_buckets", """SELECT strftime(ts, '%Y-%m') AS bucket, strftime(ts, '%Y%m%d') AS stamp, count(*) AS n FROM events GROUP BY 1, 2""")
def date_buckets(spark, sf):
    stamped = fx.table(spark, sf, "events").select(tables.date_bucket("ts").alias("bucket"), tables.date_stamp("ts").alias("stamp"))
    return stamped.groupBy("bucket", "stamp").agg(F.count("*").alias("n"))


@query("entity_ingest", f"""WITH {sql.ENTITIES} SELECT entity_id, entity_type, lang, title, length(description) AS description_length,
    sha1(description) AS description_hash, base_text_title, base_text_author, contest_title, public_url FROM ents_src""")
def entity_ingest(spark, sf):
    folder = new_folder(spark, "entities")
    tables.write_csv(fx.entities(spark, sf).drop("doc_id"), folder)
    rows = tables.read_entities(spark, folder)
    return rows.select(
        "entity_id", "entity_type", "lang", "title", F.length("description").cast("bigint").alias("description_length"),
        F.sha1("description").alias("description_hash"), "base_text_title", "base_text_author", "contest_title", "public_url",
    )


def _page_query(name, column, expression, sql_expression, source="pages"):
    prefix = f"WITH {sql.PAGES_PLUS} " if source == "pages_plus" else ""

    @query(name, f"{prefix}SELECT page_id, {sql_expression} AS {column} FROM {source}")
    def run(spark, sf):
        rows = fx.pages_plus(spark, sf) if source == "pages_plus" else fx.table(spark, sf, "pages")
        return rows.withColumn("_m", web.markup("html")).select("page_id", expression("url", "_m").alias(column))


_page_query("page_lang", "lang", lambda u, m: web.page_lang(m), sql.lang(sql.markup("html")))
_page_query("page_title", "title", lambda u, m: web.page_title(m), sql.title(sql.markup("html")))
_page_query("page_meta", "meta_description", lambda u, m: web.page_meta(m), sql.meta(sql.markup("html")), "pages_plus")
_page_query("page_canonical", "canonical", web.canonical_url, sql.canonical("url", sql.markup("html")), "pages_plus")


@query("page_headings", f"""WITH {sql.PAGES_PLUS}, m AS (SELECT page_id, {sql.markup('html')} AS m FROM pages_plus)
    SELECT page_id, {sql.headings('m', 1)} AS h1, {sql.headings('m', 2)} AS h2, {sql.headings('m', 3)} AS h3 FROM m""")
def page_headings(spark, sf):
    rows = fx.pages_plus(spark, sf).withColumn("_m", web.markup("html"))
    return rows.select("page_id", *[web.page_headings("_m", n).alias(f"h{n}") for n in (1, 2, 3)])


@query("page_main_text", f"SELECT page_id, {sql.main_text('html')} AS body_text FROM pages")
def page_main_text(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", web.main_text("html").alias("body_text"))


EVENT_URL = """(SELECT event_id, 'https://site.example/' || ['contest?id=', 'read?id=', 'book/', 'chat?id=', 'echo?id=', 'thread/', 'about?id='][(event_id % 7) + 1]
    || event_id AS url FROM events UNION ALL SELECT -1 - event_id, 'https://site.example' || CASE WHEN event_id % 2 = 0 THEN '/' ELSE '' END FROM events)"""


def _event_urls(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id")
    kind = fx.pick(("contest?id=", "read?id=", "book/", "chat?id=", "echo?id=", "thread/", "about?id="), F.col("event_id") % 7)
    paths = events.select("event_id", F.concat(F.lit("https://site.example/"), kind, F.col("event_id").cast("string")).alias("url"))
    slash = F.when(F.col("event_id") % 2 == 0, "/").otherwise("")
    home = events.select((-1 - F.col("event_id")).alias("event_id"), F.concat(F.lit("https://site.example"), slash).alias("url"))
    return paths.unionByName(home)


@query("page_content_type", f"SELECT event_id, url, {sql.content_type('url')} AS content_type FROM {EVENT_URL}")
def page_content_type(spark, sf):
    return _event_urls(spark, sf).select("event_id", "url", web.content_type("url").alias("content_type"))


@query("page_ids", f"""SELECT event_id, {sql.page_id_column('url', 'contest')} AS course_id, {sql.page_id_column('url', 'reading')} AS reading_id,
    {sql.page_id_column('url', 'echo')} AS echo_id FROM {EVENT_URL}""")
def page_ids(spark, sf):
    return _event_urls(spark, sf).select("event_id", *[c.alias(n) for n, c in web.page_ids("url").items()])


@query("page_links", f"""WITH {sql.PAGES_PLUS}, {sql.links_cte('pages_plus')}
    SELECT page_id, array_to_string(list_sort(list(link)), '|') AS internal_links FROM links GROUP BY page_id""")
def page_links(spark, sf):
    links = web.internal_links("url", web.markup("html"))
    return fx.pages_plus(spark, sf).select("page_id", F.array_join(links, "|").alias("internal_links"))


@query("link_edges", f"WITH {sql.links_cte('pages')} SELECT src, link AS dst FROM links")
def link_edges(spark, sf):
    return op.link_edges(fx.table(spark, sf, "pages"))


@query("parse_pages", f"""WITH {sql.links_cte('pages')}, joined AS (SELECT page_id, array_to_string(list_sort(list(link)), '|') AS internal_links
    FROM links GROUP BY page_id), {sql.PARSED}
    SELECT p.*, coalesce(j.internal_links, '') AS internal_links FROM parsed p LEFT JOIN joined j USING (page_id)""")
def parse_pages(spark, sf):
    parsed = op.parse_pages(fx.table(spark, sf, "pages")).drop("created_at")
    return parsed.withColumn("internal_links", F.array_join("internal_links", "|"))


@query("seed_urls", f"""WITH sites AS (SELECT regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || '/' AS base_url, min(page_id) AS id_start, min(page_id) + count(*) - 1 AS id_end
      FROM pages GROUP BY 1)
    SELECT base_url, base_url AS url FROM sites UNION ALL
    SELECT base_url, base_url || unnest(['contest?id=' || id, 'read/' || id]) AS url FROM (SELECT base_url, unnest(range(id_start, id_end + 1)) AS id FROM sites)""")
def seed_urls(spark, sf):
    base = F.concat(F.regexp_extract("url", r"^[a-z]+://[^/?#]*", 0), F.lit("/"))
    sites = fx.table(spark, sf, "pages").groupBy(base.alias("base_url")).agg(
        F.min("page_id").alias("id_start"), (F.min("page_id") + F.count("*") - 1).alias("id_end")
    )
    return op.seed_urls(sites, ("/contest?id={id}", "/read/{id}"))


GRAPH = """nodes AS (SELECT count(*) AS n FROM part), edges AS (SELECT DISTINCT l_partkey AS src, (l_partkey * 7 + l_linenumber * 13) % n AS dst FROM lineitem, nodes)"""


def _graph(spark, sf):
    nodes = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("url"))
    size = fx.table(spark, sf, "part").agg(F.count("*")).scalar()
    line = fx.table(spark, sf, "lineitem")
    target = (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % size
    return nodes, line.select(F.col("l_partkey").alias("src"), target.alias("dst")).distinct()


@query("reachable_pages", f"""WITH RECURSIVE {GRAPH}, walk AS (SELECT 0::BIGINT AS url, 0 AS depth
    UNION SELECT e.dst, depth + 1 FROM walk JOIN edges e ON e.src = walk.url JOIN part ON p_partkey = e.dst WHERE depth < 4)
    SELECT url, min(depth) AS depth FROM walk GROUP BY url""")
def reachable_pages(spark, sf):
    nodes, edges = _graph(spark, sf)
    seeds = nodes.where("url = 0").withColumn("ord", F.lit(0).cast("bigint"))
    return op.reachable_pages(nodes, edges, seeds, max_depth=4, max_pages=None).select("url", "depth")


@query("crawl_order", f"""WITH {GRAPH}, l0 AS (SELECT p_partkey AS url, p_partkey AS visit_rank FROM part WHERE p_partkey < 3),
    c1 AS (SELECT dst AS url, min(visit_rank) AS pr FROM edges JOIN l0 ON src = l0.url WHERE dst NOT IN (SELECT url FROM l0) GROUP BY dst),
    l1 AS (SELECT url, 2 + row_number() OVER (ORDER BY pr, url) AS visit_rank FROM c1 JOIN part ON p_partkey = url),
    c2 AS (SELECT dst AS url, min(visit_rank) AS pr FROM edges JOIN l1 ON src = l1.url WHERE dst NOT IN (SELECT url FROM l0 UNION ALL SELECT url FROM l1) GROUP BY dst),
    l2 AS (SELECT url, (SELECT count(*) FROM l1) + 2 + row_number() OVER (ORDER BY pr, url) AS visit_rank FROM c2 JOIN part ON p_partkey = url)
    SELECT url, depth, visit_rank FROM (SELECT *, 0 AS depth FROM l0 UNION ALL SELECT *, 1 FROM l1 UNION ALL SELECT *, 2 FROM l2) WHERE visit_rank < 200""")
def crawl_order(spark, sf):
    """First-in first-out visit; the page limit is the crawl's own parameter."""
    nodes, edges = _graph(spark, sf)
    seeds = nodes.where("url < 3").withColumn("ord", F.col("url"))
    return op.reachable_pages(nodes, edges, seeds, max_depth=2)


@query("url_policy", f"""WITH u AS (SELECT page_id, url, {sql.url_part('url', 'host')} AS host, {sql.url_part('url', 'path')}
      || CASE WHEN {sql.url_part('url', 'query')} <> '' THEN '?' || {sql.url_part('url', 'query')} ELSE '' END AS target FROM pages),
    r AS (SELECT unnest([{{'p': '/', 'a': true}}, {{'p': '/en/', 'a': false}}, {{'p': '/en/6', 'a': true}}]) AS r)
    SELECT page_id, url, coalesce(arg_max(r.a, length(r.p)) FILTER (WHERE NOT starts_with(host, 'm.') AND starts_with(target, r.p)), true) AS allowed
    FROM u, r GROUP BY ALL""")
def url_policy(spark, sf):
    pages = fx.table(spark, sf, "pages").select("page_id", "url")
    hosts = pages.select(web.url_part("url", "host").alias("host")).distinct().where(~F.col("host").startswith("m."))
    rule = F.inline(
        F.array(
            *[
                F.struct(F.lit("*").alias("agent"), F.lit(p).alias("path_prefix"), F.lit(a).alias("allow"))
                for p, a in (("/", True), ("/en/", False), ("/en/6", True))
            ]
        )
    )
    return op.apply_url_policy(pages, hosts.select("host", rule)).select("page_id", "url", "allowed")
