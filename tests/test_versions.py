"""Tables that rewrite what they read, stages run twice, digests of runs, rules by prefix."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from termtide.operators import merge, pages
from termtide.operators.score import score
from termtide.plans import stages
from termtide.session import new_folder
from termtide.sources import raw as raw_io
from termtide.sources.versions import current_version, read_current, write_version
from termtide.streaming import intake

from .test_golden import KEYWORDS
from .test_responses import MARKET, envelope, parsed


def folders(path):
    return sorted(f for f in os.listdir(path) if not f.startswith("."))


def test_a_table_may_be_rewritten_from_itself(spark):
    path = new_folder(spark, "t")
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    write_version(spark.range(3).withColumn("n", F.lit(0)), path)
    for n in (1, 2):
        write_version(read_current(spark, path).withColumn("n", F.col("n") + 1), path)
        assert [r.n for r in read_current(spark, path).collect()] == [n] * 3
        assert folders(path) == ["_current", current_version(spark, path)]
    before = current_version(spark, path)
    with pytest.raises(PySparkException):
        write_version(read_current(spark, path).withColumn("n", F.raise_error(F.lit("x"))), path)
    assert current_version(spark, path) == before and read_current(spark, path).count() == 3
    write_version(read_current(spark, path), path, keep=1)
    assert folders(path) == sorted(["_current", before, current_version(spark, path)])


@pytest.fixture(scope="module")
def master(spark):
    rows = spark.createDataFrame([(k, "s", "e", 2840, "en", v, 0.1, c, "LOW", 1.0, "", None) for k, v, c in KEYWORDS], "keyword string, source_term string, source_endpoint string, location_code int, language_code string, search_volume bigint, cpc double, competition double, competition_level string, keyword_difficulty double, categories string, collected_at timestamp")
    return score(merge.merge_keywords(rows, None, "keyword"), None)


def test_stages_run_twice_give_the_same(spark, master):
    path, log = new_folder(spark, "master"), new_folder(spark, "log")
    write_version(master, path)
    page = [{"result": [{"items": [{"type": "video"}, {"type": "organic", "domain": "d.example"}]}]}]
    graph = [{"result": [{"items": [{"type": "google_trends_graph", "keywords": ["hamlet summary"], "data": [{"values": [v]} for v in (1, 5, 9, 20)]}]}]}]
    raw_io.append_raw(parsed(spark, *[envelope("serp/google/organic", {"keyword": k, **MARKET}, page) for k, _, _ in KEYWORDS],
                             envelope("google_trends", {"keywords": ["hamlet summary"], **MARKET}, graph)), log)
    found = []
    for _ in range(2):
        stages.refresh_serp(spark, path, log, 4)
        rows = stages.refresh_trends(spark, path, log).collect()
        found.append(sorted((r.keyword, r.serp_intent or "", r.serp_top_domains or "", r.trend_direction or "") for r in rows))
        assert len(folders(path)) == 2
    assert found[0] == found[1] and len(found[0]) == 10
    assert sum(r[1] == "video" for r in found[0]) == 4 and [r[3] for r in found[0] if r[0] == "hamlet summary"] == ["rising"]


def test_the_report_in_one_call(spark, master):
    path = new_folder(spark, "report")
    for _ in range(2):
        stages.write_report(master, path)
    assert {f.removesuffix(".csv") for f in os.listdir(path)} == set(stages.report_tables(master))
    assert read_current(spark, f"{path}/totals").first()["keywords"] == 10
    assert spark.read.option("header", True).csv(f"{path}/opportunities.csv").count() == 10


def test_runs_are_told_apart_by_digests(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "x"), (9, "z", "z")], "id int, t string, u string")
    new = spark.createDataFrame([(1, "a", ""), (2, "b", "x"), (4, "d", None), (3, "cx", ""), (None, "n", "n")], "id int, t string, u string")
    kept = intake.digests(old, ["id"], ["t", "u"])
    assert kept.columns == ["id", "_digest"]
    rows = intake.changed_rows(new, kept, ["id"], ["t", "u"], gone=True)
    assert rows.columns == ["id", "t", "u", "change"]
    assert {tuple(r) for r in rows.collect()} == {(1, "a", "", "changed"), (3, "cx", "", "changed"), (4, "d", None, "new"), (9, None, None, "gone"), (None, "n", "n", "new")}
    # only keys and digests go into the comparison
    plan = intake.changed_keys(intake.digests(new, ["id"], ["t", "u"]), kept, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join FullOuter")
    assert all(" t#" not in line.split("[")[0] for line in plan[join:].splitlines()[:2])


def test_a_host_with_very_many_rules(spark):
    rules = spark.range(1_000_000).select(F.lit("hot").alias("host"), F.lit("*").alias("agent"), F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("path_prefix"), (F.col("id") % 2 == 0).alias("allow"))
    rules = rules.union(spark.createDataFrame([("own", "bot", "/x", False), ("own", "*", "/", False), ("all", "*", "", False)], rules.schema))
    urls = spark.range(20_000).select(F.concat(F.lit("https://hot/d/"), F.col("id").cast("string"), F.when(F.col("id") % 5 == 0, "x").otherwise("")).alias("url"))
    urls = urls.union(spark.createDataFrame([("https://own/x/1",), ("https://own/y",), ("https://all/",), ("https://hot/e",), (None,)], "url string"))
    got = {r.url: r.allowed for r in pages.apply_url_policy(urls, rules, "bot").collect()}
    assert all(got[f"https://hot/d/{i}" + ("x" if i % 5 == 0 else "")] == (i % 2 == 0) for i in range(20_000))
    assert [got[u] for u in ("https://own/x/1", "https://own/y", "https://all/", "https://hot/e", None)] == [False, True, False, True, True]
