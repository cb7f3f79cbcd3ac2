"""Logged nested responses to flat tables. No operator here shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import IDEAS_ENDPOINT, SERP_INTENT_OTHER, SERP_INTENTS, SITE_ENDPOINT, TERM_ENDPOINTS
from ..functions import series
from ..functions.text import to_number
from ..schemas import DISCOVERED, METRICS, SERP_INTENT, TREND_TABLE
from ..sources.raw import log_of
from .planning import IDEAS_SOURCE

OK = 20000
GRAPH = "google_trends_graph"
ORGANIC = "organic"
TOP_DOMAINS = 5
# The logs of result pages and of interest graphs.
SERP_ENDPOINTS = ("organic",)
TREND_ENDPOINTS = ("google_trends", "trends")


def is_ok(status: Column) -> Column:
    return status.isNull() | (status == OK)


def usable(raw: DataFrame, *endpoints: str) -> DataFrame:
    """Envelopes whose response as a whole succeeded, of the given endpoints."""
    kept = raw.where(is_ok(F.col("response.status_code")))
    named = kept.withColumn("source_endpoint", log_of(raw))
    return named.where(F.col("source_endpoint").isin(*endpoints)) if endpoints else named


def flatten_results(raw: DataFrame, *endpoints: str) -> DataFrame:
    """One row per result of every successful task, with its request."""
    tasks = usable(raw, *endpoints).select(
        "source_endpoint", F.get("request", F.lit(0)).alias("request"), "collected_at",
        F.explode("response.tasks").alias("task"),
    )
    good = tasks.where(F.col("task").isNotNull() & is_ok(F.col("task.status_code")))
    return good.select("source_endpoint", "request", "collected_at", F.explode("task.result").alias("result"))


def _any_field(struct: str, fields: Sequence[str]) -> Column:
    """An empty object reads as a struct of nulls: present means a field is."""
    found = F.lit(False)
    for f in fields:
        found = found | F.col(f"{struct}.{f}").isNotNull()
    return F.col(struct).isNotNull() & found


INFO_FIELDS = ("search_volume", "cpc", "competition", "competition_level", "categories")


def _keyword_rows(results: DataFrame) -> DataFrame:
    """Discovery results of any endpoint to the discovered contract, in one pass."""
    items = results.select("*", F.explode("result.items").alias("item")).where(F.col("item").isNotNull())
    site = F.col("source_endpoint") == SITE_ENDPOINT
    data = _any_field("item.keyword_data", ("keyword", "keyword_info", "keyword_properties"))
    own_info = _any_field("item.keyword_info", INFO_FIELDS)

    def info(field: str) -> Column:
        inline = F.when(own_info, F.col(f"item.keyword_info.{field}")).otherwise(F.col(f"item.{field}"))
        nested = F.when(data, F.col(f"item.keyword_data.keyword_info.{field}")).otherwise(
            F.col(f"item.keyword_info.{field}")
        )
        return F.when(site, inline).otherwise(nested)

    nested_keyword = F.when(data, F.col("item.keyword_data.keyword"))
    difficulty = F.when(data, F.col("item.keyword_data.keyword_properties.keyword_difficulty")).otherwise(
        F.col("item.keyword_properties.keyword_difficulty")
    )
    source = (
        F.when(site, F.concat(F.lit("site:"), F.col("request.target")))
        .when(F.col("source_endpoint") == IDEAS_ENDPOINT, IDEAS_SOURCE)
        .otherwise(F.col("request.keyword"))
    )
    rows = items.select(
        F.when(site, F.coalesce("item.keyword", "item.keyword_info.keyword")).otherwise(F.coalesce("item.keyword", nested_keyword)).alias("keyword"),
        source.alias("source_term"),
        "source_endpoint",
        F.col("request.location_code").alias("location_code"),
        F.col("request.language_code").alias("language_code"),
        info("search_volume").alias("search_volume"),
        info("cpc").alias("cpc"),
        to_number(info("competition")).alias("competition"),
        info("competition_level").alias("competition_level"),
        F.when(~site, difficulty).alias("keyword_difficulty"),
        F.coalesce(F.array_join(info("categories"), "|", "None"), F.lit("")).alias("categories"),
        "collected_at",
    )
    return rows.where("keyword <> ''").select(*DISCOVERED.fieldNames())


def flatten_labs(raw: DataFrame) -> DataFrame:
    """Suggestion, related and ideas responses; metrics sit under the item or its data."""
    return _keyword_rows(flatten_results(raw, *TERM_ENDPOINTS, IDEAS_ENDPOINT))


def flatten_site(raw: DataFrame) -> DataFrame:
    """Site responses; metrics sit in the item's info or in the item itself."""
    return _keyword_rows(flatten_results(raw, SITE_ENDPOINT))


def discovered(raw: DataFrame) -> DataFrame:
    """All discovery endpoints, read once, with provenance from the logged request."""
    return _keyword_rows(flatten_results(raw, *TERM_ENDPOINTS, IDEAS_ENDPOINT, SITE_ENDPOINT))


VOLUME_FIELDS = (
    "keyword", "search_volume", "monthly_searches", "cpc", "competition", "competition_index",
    "low_top_of_page_bid", "high_top_of_page_bid",
)


def flatten_volume(raw: DataFrame, *endpoints: str) -> DataFrame:
    """Volume responses to the metrics contract; a result has items or is one itself."""
    results = flatten_results(raw, *(endpoints or ("search_volume",)))
    listed = F.transform("result.items", lambda i: F.struct(*[i[f].alias(f) for f in VOLUME_FIELDS]))
    itself = F.array(F.struct(*[F.col(f"result.{f}").alias(f) for f in VOLUME_FIELDS]))
    items = results.select("request", "collected_at", F.explode(F.coalesce(listed, itself)).alias("item"))
    named = items.where(F.col("item.keyword") != "")
    months = named.withColumn("monthly_searches", series.sort_monthly("item.monthly_searches"))
    return months.select(
        F.col("item.keyword").alias("keyword"),
        F.col("request.location_code").alias("location_code"),
        F.col("request.language_code").alias("language_code"),
        F.col("item.search_volume").alias("search_volume"),
        "monthly_searches",
        series.latest_month("monthly_searches").alias("latest_month_searches"),
        series.pct_trend("monthly_searches", 3).alias("trend_3m"),
        series.pct_trend("monthly_searches", 12).alias("trend_12m"),
        F.col("item.cpc").alias("cpc"),
        to_number(F.col("item.competition")).alias("competition"),
        F.col("item.competition_index").alias("competition_index"),
        F.col("item.low_top_of_page_bid").alias("low_top_of_page_bid"),
        F.col("item.high_top_of_page_bid").alias("high_top_of_page_bid"),
        "collected_at",
    ).select(*METRICS.fieldNames())


def _response_items() -> Column:
    """All items of a response's successful tasks, in order, as one array."""
    tasks = F.filter(
        F.coalesce("response.tasks", F.array()), lambda t: t.isNotNull() & is_ok(t["status_code"]) & t["result"].isNotNull()
    )
    results = F.filter(F.flatten(F.transform(tasks, lambda t: t["result"])), lambda r: r["items"].isNotNull())
    return F.filter(F.flatten(F.transform(results, lambda r: r["items"])), lambda i: i.isNotNull())


def serp_intent(features: Column | str) -> Column:
    """Intent of a set of result element types, first matching group wins."""
    col = F.col(features) if isinstance(features, str) else features
    label = F.when(F.lit(False), "")
    for name, types in SERP_INTENTS:
        label = label.when(F.arrays_overlap(col, F.array(*[F.lit(t) for t in types])), name)
    return label.otherwise(SERP_INTENT_OTHER)


def flatten_serp(raw: DataFrame, *endpoints: str) -> DataFrame:
    """Result pages to one row per response: intent, element types, first organic domains."""
    rows = usable(raw, *(endpoints or SERP_ENDPOINTS)).select(
        F.get("request", F.lit(0))["keyword"].alias("keyword"), "collected_at", _response_items().alias("_items")
    )
    typed = F.filter("_items", lambda i: i["type"] != "")
    organic = F.filter("_items", lambda i: (i["type"] == ORGANIC) & (i["domain"] != ""))
    parts = rows.select(
        "keyword", "collected_at",
        F.sort_array(F.array_distinct(F.transform(typed, lambda i: i["type"]))).alias("_features"),
        F.slice(F.transform(organic, lambda i: i["domain"]), 1, TOP_DOMAINS).alias("_domains"),
    )
    return parts.select(
        "keyword",
        serp_intent("_features").alias("serp_intent"),
        F.array_join("_features", "|").alias("serp_features"),
        F.array_join("_domains", "|").alias("serp_top_domains"),
        F.col("collected_at").alias("serp_checked_at"),
    ).select(*SERP_INTENT.fieldNames())


def interest_series(raw: DataFrame, *endpoints: str) -> DataFrame:
    """One row per requested keyword: its interest values from the first graph that has any.

    A point without a value for the keyword gives the point's first value instead,
    so another keyword's value can stand in: that is the contract.
    """
    rows = usable(raw, *(endpoints or TREND_ENDPOINTS)).select(
        "collected_at", F.explode(F.get("request", F.lit(0))["keywords"]).alias("keyword"),
        F.filter(_response_items(), lambda i: i["type"] == GRAPH).alias("_graphs"),
    )

    def graph_values(graph: Column) -> Column:
        names = F.transform(F.coalesce(graph["keywords"], F.array().cast("array<string>")), F.lower)
        place = F.coalesce(F.array_position(names, F.lower(F.col("keyword"))), F.lit(0)).cast("int")
        points = F.filter(F.coalesce(graph["data"], F.array()), lambda p: p.isNotNull())

        def point(p: Column) -> Column:
            own = F.when(place > 0, F.get(p["values"], place - 1))
            return F.coalesce(own, F.get(p["values"], F.lit(0)))

        return F.filter(F.transform(points, point), lambda v: v.isNotNull())

    found = F.filter(F.transform("_graphs", graph_values), lambda v: F.size(v) > 0)
    values = F.coalesce(F.get(found, F.lit(0)), F.array().cast("array<double>"))
    return rows.select("keyword", values.alias("values"), "collected_at")


def trend_table(raw: DataFrame, *endpoints: str) -> DataFrame:
    """Interest series summed up to the trend contract."""
    rows = interest_series(raw, *endpoints)
    summary = series.interest_summary("values")
    columns = [c.alias(name) for name, c in summary.items()]
    return rows.select("keyword", *columns, F.col("collected_at").alias("trend_checked_at")).select(*TREND_TABLE.fieldNames())
