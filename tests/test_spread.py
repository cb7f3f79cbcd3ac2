"""Numbering, batching, lookups, reachability, policies, budgets."""

import re

import pytest
from pyspark.sql import functions as F

from termtide import session
from termtide.config import resolve_market
from termtide.operators import pages, planning, spread


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_index_is_gap_free_and_ordered(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("k"), "id").repartition(7)
    rows = spread.with_index(df, "k", "id").collect()
    assert sorted(r.idx for r in rows) == list(range(n))
    by_idx = [(r.k, r.id) for r in sorted(rows, key=lambda r: r.idx)]
    assert by_idx == sorted(by_idx)


def test_batches_cover_every_item_once(spark):
    df = spark.range(2503).select(F.format_string("k%05d", F.col("id") * 13 % 2503).alias("keyword"))
    rows = planning.plan_batches(df, "keyword", 1000).orderBy("batch").collect()
    assert [r.n for r in rows] == [1000, 1000, 503]
    assert [k for r in rows for k in r["items"]] == sorted(f"k{i:05d}" for i in range(2503))


def test_lookup_keeps_all_rows_of_a_hot_key(spark):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("1", 2), ("unused", 3)], "k string, v int")
    out = spread.lookup_join(rows, lookup, on=["k"])
    assert out.count() == 9000 and out.where("v = 1").count() == 3000 and out.where("v = 2").count() == 1
    assert out.columns == ["k", "id", "v"]


def graph(spark):
    edges = [("s", "b"), ("s", "a"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "e"), ("e", "f"), ("s", "gone"), ("gone", "g"), ("d", "s")]
    names = spark.createDataFrame([(c,) for c in ("s", "a", "b", "c", "d", "e", "f", "g")], "url string")
    seeds = spark.createDataFrame([("s", 0), ("s", 1), ("missing", 2)], "url string, ord bigint")
    return names, spark.createDataFrame(edges, "src string, dst string"), seeds


def test_reachability_is_bounded_by_depth_and_existing_pages(spark):
    names, edges, seeds = graph(spark)
    last = set()
    for depth, expected in enumerate([{"s": 0}, {"s": 0, "a": 1, "b": 1}, {"s": 0, "a": 1, "b": 1, "c": 2, "d": 2}]):
        rows = pages.reachable_pages(names, edges, seeds, max_depth=depth, max_pages=None).collect()
        assert {r.url: r.depth for r in rows} == expected
        assert last <= set(expected)
        last = set(expected)


def test_visit_order_is_first_in_first_out(spark):
    names, edges, seeds = graph(spark)
    full = pages.reachable_pages(names, edges, seeds, max_depth=4, max_pages=200).orderBy("visit_rank").collect()
    assert [r.url for r in full] == ["s", "a", "b", "c", "d", "e", "f"]
    cut = pages.reachable_pages(names, edges, seeds, max_depth=4, max_pages=4).orderBy("visit_rank").collect()
    assert [(r.url, r.visit_rank) for r in cut] == [("s", 0), ("a", 1), ("b", 2), ("c", 3)]


def test_crawl_without_a_limit_has_the_same_columns_and_order(spark):
    names, edges, seeds = graph(spark)
    odd = edges.union(edges).union(spark.createDataFrame([("s", None), (None, "a"), ("a", "a")], "src string, dst string"))
    twice = names.union(names).union(spark.createDataFrame([(None,)], "url string"))
    none = pages.reachable_pages(twice, odd, seeds, max_depth=4, max_pages=None)
    some = pages.reachable_pages(names, edges, seeds, max_depth=4, max_pages=200)
    assert none.schema == some.schema and sorted(none.collect()) == sorted(some.collect())
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("termtide_")]
    assert pages.reachable_pages(names, edges.limit(0), seeds).count() == 1
    assert pages.reachable_pages(names.limit(0), edges, seeds).count() == 0
    assert pages.reachable_pages(names, edges, seeds, max_pages=0).count() == 0


def test_crawl_stays_on_its_hosts(spark):
    urls = ["https://a.example/", "https://a.example/1", "https://b.example/", "https://a.example/2"]
    names = spark.createDataFrame([(u,) for u in urls], "url string")
    edges = spark.createDataFrame([(urls[0], urls[1]), (urls[0], urls[2]), (urls[2], urls[3])], "src string, dst string")
    seeds = spark.createDataFrame([(urls[0], 0)], "url string, ord bigint")
    assert pages.reachable_pages(names, edges, seeds, max_depth=3).count() == 4
    own = pages.reachable_pages(names, edges, seeds, max_depth=3, hosts=["a.example"]).collect()
    assert sorted(r.url for r in own) == urls[:2]


def test_crawl_levels_do_not_shuffle_edges_or_pages(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with session.buckets(spark) as tables:
            names, edges, _ = graph(spark)
            known, links = tables.write(names, "pages", "url")[0], tables.write(edges, "edges", "src")[0]
            visited = [tables.write(spark.createDataFrame([(u,)], "url string"), "level", "url")[0] for u in "sa"]
            level = spark.createDataFrame([("a", 1)], "url string, visit_rank bigint")
            queue = pages.unvisited(pages.linked_from(links, level), known, visited)
            plan = queue._jdf.queryExecution().executedPlan().toString()
            # the level goes to the edges by its url, and what it links to to the pages
            assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["dst", "src"]
            assert [r.url for r in queue.collect()] == ["c"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_url_policy(spark):
    ddl = "host string, agent string, path_prefix string, allow boolean"
    rules = spark.createDataFrame(
        [("h", "*", "/", True), ("h", "*", "/p", False), ("h", "*", "/p/ok", True), ("h", "bot", "/q", False), ("h", "*", "/t", True), ("h", "*", "/t", False)], ddl
    )
    urls = spark.createDataFrame([(u,) for u in ("https://h/p/x", "https://h/p/ok/1", "https://h/", "https://o/p", "https://h/q?z=1", "https://h/t")], "url string")
    anyone = {r.url: r.allowed for r in pages.apply_url_policy(urls, rules, "other").collect()}
    assert anyone == {"https://h/p/x": False, "https://h/p/ok/1": True, "https://h/": True, "https://o/p": True, "https://h/q?z=1": True, "https://h/t": True}
    bot = {r.url: r.allowed for r in pages.apply_url_policy(urls, rules, "bot").collect()}
    assert bot["https://h/q?z=1"] is False and bot["https://h/p/x"] is True


def test_seeds(spark):
    sites = spark.createDataFrame([("https://h/", 1, 25000), ("https://o/base/", None, None)], "base_url string, id_start bigint, id_end bigint")
    urls = [r.url for r in pages.seed_urls(sites, ("/contest?id={id}", "r/{id}")).collect()]
    assert len(urls) == len(set(urls)) == 2 + 2 * 25000
    assert {"https://h/", "https://o/base/", "https://h/contest?id=25000", "https://h/r/1"} <= set(urls)


def test_plan_and_budget_and_reuse(spark):
    terms = spark.createDataFrame([("b",), ("a",)], "term string")
    plan = planning.plan_discovery(terms, ["x.example"], "term")
    rows = sorted(tuple(r) for r in plan.collect())
    assert rows == [
        (0, "keyword_suggestions", "a", 1), (1, "related_keywords", "a", 1), (2, "keyword_suggestions", "b", 1),
        (3, "related_keywords", "b", 1), (4, "keyword_ideas", "<batch>", 2), (5, "keywords_for_site", "site:x.example", 0),
    ]
    capped = planning.cap_calls(plan, 2)
    assert capped.count() == 6 and capped.where("planned").count() == 2
    none = planning.plan_discovery(terms.where("false"), ["x.example"], "term").collect()
    assert [tuple(r) for r in none] == [(0, "keywords_for_site", "site:x.example", 0)]
    keyed = planning.with_reuse_key(plan, terms, "term", location_code=1, language_code=None, bucket="2024-01")
    left = planning.without_logged(keyed, keyed.where("call_idx = 0").select("reuse.*"))
    assert sorted(r.call_idx for r in left.collect()) == [1, 2, 3, 4, 5]


def test_markets():
    assert resolve_market().key == "us-en" and resolve_market("il-ru").location_code == 2376
    with pytest.raises(KeyError, match="us-en, uk-en"):
        resolve_market("nowhere")
