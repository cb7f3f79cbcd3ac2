"""Raw logs of nested responses: scan, append, flatten, enrich, incremental intake."""

from __future__ import annotations

from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, functions as F

from ..functions import series
from ..config import KNOWN_LOGS
from ..operators import enrich, responses as op
from ..plans import stages
from ..schemas import CALL_ENVELOPE, DISCOVERED
from ..session import new_folder, passing_stage, stage
from ..sources import raw as raw_io
from ..sources.versions import write_version
from ..streaming import intake
from . import fixtures as fx, sql
from .keyword_queries import KEY, KEY_SQL, scored
from .registry import query

SITE = "one.example"
LABS = ("keyword_suggestions", "related_keywords", "keyword_ideas")


def _null(ddl: str) -> Column:
    return F.lit(None).cast(ddl)


def _discovery_item(found: Column) -> Column:
    """A discovered keyword in one of the shapes that endpoints give it."""
    variant, keyword, categories = found["variant"], found["keyword"], F.array(found["categories"])
    numbers = [found[c].alias(c) for c in ("search_volume", "cpc", "competition", "competition_level")]
    info = F.struct(*numbers, categories.alias("categories"))
    info_type = "struct<search_volume:bigint,cpc:double,competition:double,competition_level:string,categories:array<string>>"
    no_info = F.struct(*[_null(t).alias(n) for n, t in (
        ("search_volume", "bigint"), ("cpc", "double"), ("competition", "double"), ("competition_level", "string"), ("categories", "array<string>"))])
    props = F.struct(found["keyword_difficulty"].alias("keyword_difficulty"))
    data = F.struct(keyword.alias("keyword"), info.alias("keyword_info"), props.alias("keyword_properties"))
    no_data = F.struct(
        _null("string").alias("keyword"), _null(info_type).alias("keyword_info"), _null("struct<keyword_difficulty:double>").alias("keyword_properties")
    )
    inline = variant == 4
    return F.struct(
        F.when(variant != 1, keyword).alias("keyword"),
        F.when(variant == 1, data).when(variant == 2, no_data).alias("keyword_data"),
        F.when(variant.isin(0, 2, 3), info).when(inline, no_info).alias("keyword_info"),
        F.when(variant.isin(0, 2), props).alias("keyword_properties"),
        *[F.when(inline, found[c]).alias(c) for c in ("search_volume", "cpc", "competition", "competition_level")],
        F.when(inline, categories).alias("categories"),
    )


def discovery_log(spark, sf, rows=None):
    """Envelopes of discovered keywords (``fx.disc``) as JSON lines, with failures and shape variants."""
    # one call returns a bounded page of items: at most 1000 orders' worth here
    chunk = F.floor(F.col("l_orderkey") / 1000)
    rows = fx.disc(spark, sf) if rows is None else rows
    variant = F.when(F.col("source_endpoint") == "keywords_for_site", F.col("ord") % 2 + 3).otherwise(F.col("ord") % 3)
    keyword = F.when(F.col("ord") % 50 == 0, "").otherwise(F.col("keyword"))
    found = F.struct(
        variant.cast("int").alias("variant"), keyword.alias("keyword"), "search_volume", "cpc", "competition", "competition_level",
        "keyword_difficulty", "categories",
    )
    # an item is made once, as the text that the line has of it: only that is collected
    items = rows.withColumn("item", F.to_json(_discovery_item(found)))
    calls = items.groupBy("source_term", "source_endpoint", "location_code", "language_code", chunk.alias("chunk")).agg(
        F.array_join(F.collect_list("item"), ",").alias("items"), F.date_trunc("quarter", F.max("collected_at")).alias("collected_at")
    )
    g = F.col("chunk") * 7 + F.col("location_code") * 3 + F.substring("source_term", 7, 3).cast("int")
    endpoint = F.col("source_endpoint")
    request = F.struct(
        F.when(endpoint.isin("keyword_suggestions", "related_keywords"), F.col("source_term")).alias("keyword"),
        F.when(endpoint == "keyword_ideas", F.array("source_term")).alias("keywords"),
        F.when(endpoint == "keywords_for_site", SITE).alias("target"),
        "location_code", "language_code",
    )
    task = F.struct(
        F.when(g % 10 == 0, 40501).when(g % 10 != 1, 20000).alias("status_code"),
        F.when(g % 20 != 3, F.array(F.struct(F.array().cast("array<string>").alias("items")))).alias("result"),
    )
    response = F.struct(F.when(g % 15 == 7, 40000).otherwise(20000).alias("status_code"), F.array(task).alias("tasks"))
    envelope = F.struct(
        F.concat(F.lit("/v3/labs/"), endpoint, F.lit("/live")).alias("endpoint"), F.array(request).alias("request"),
        response.alias("response"), "collected_at",
    )
    # no string of a line has these characters: its quotes are escaped
    filled = F.concat(F.lit('"items":['), "items", F.lit("]"))
    return calls.select(F.replace(F.to_json(envelope), F.lit('"items":[]'), filled).alias("value"))


def discovery_raw(spark, sf):
    return raw_io.parse_raw(discovery_log(spark, sf))


CALLS = f"""{sql.DISC}, numbered AS (SELECT *, l_orderkey // 1000 AS chunk, (l_orderkey // 1000) * 7 + location_code * 3 + substr(source_term, 7)::INT AS g FROM disc),
  calls AS (SELECT source_term, source_endpoint, location_code, language_code, chunk, g, count(*) AS n_items, date_trunc('quarter', max(collected_at)) AS collected_at FROM numbered GROUP BY ALL)"""
ALIVE = "g % 15 <> 7 AND g % 10 <> 0 AND g % 20 <> 3"


def _found(where: str) -> str:
    return f"""WITH {CALLS} SELECT keyword, CASE source_endpoint WHEN 'keyword_ideas' THEN '<batch>' WHEN 'keywords_for_site' THEN 'site:{SITE}' ELSE source_term END AS source_term,
      source_endpoint, location_code, language_code, search_volume, cpc, competition, competition_level,
      CASE WHEN source_endpoint <> 'keywords_for_site' THEN keyword_difficulty END AS keyword_difficulty, categories
      FROM numbered WHERE {ALIVE} AND ord % 50 <> 0 AND {where}"""


@query("raw_scan", f"WITH {CALLS} SELECT source_endpoint, CASE WHEN g % 15 = 7 THEN 40000 ELSE 20000 END AS status_code, count(*) AS n FROM calls GROUP BY 1, 2")
def raw_scan(spark, sf):
    folder = new_folder(spark, "raw")
    lines = discovery_log(spark, sf)
    spaced = lines.select(F.explode(F.array("value", F.lit(""), F.lit("  "))).alias("value"))
    spaced.write.text(folder, compression=raw_io.CODEC)
    rows = raw_io.read_raw(spark, folder)
    return rows.groupBy(raw_io.log_name("endpoint").alias("source_endpoint"), F.col("response.status_code").alias("status_code")).agg(F.count("*").alias("n"))


@query("raw_roundtrip", f"WITH {CALLS} SELECT source_endpoint, strftime(collected_at, '%Y%m%d') AS stamp, 2 * count(*) AS n, 2 * sum(CASE WHEN g % 20 <> 3 THEN n_items ELSE 0 END)::BIGINT AS n_items FROM calls GROUP BY 1, 2")
def raw_roundtrip(spark, sf):
    rows = raw_io.read_raw(spark, _logged(spark, sf, times=2))
    items = F.aggregate(F.flatten(F.filter(F.transform("response.tasks", lambda t: t["result"]), lambda r: r.isNotNull())),
                        F.lit(0).cast("bigint"), lambda a, r: a + F.size(r["items"]))
    return rows.groupBy(raw_io.log_name("endpoint").alias("source_endpoint"), F.date_format("collected_at", "yyyyMMdd").alias("stamp")).agg(
        F.count("*").alias("n"), F.sum(items).alias("n_items")
    )


@query("flatten_results", f"WITH {CALLS} SELECT source_endpoint, location_code, language_code, count(*) AS results, sum(n_items)::BIGINT AS n_items FROM calls WHERE {ALIVE} GROUP BY 1, 2, 3")
def flatten_results(spark, sf):
    rows = op.flatten_results(discovery_raw(spark, sf))
    return rows.groupBy("source_endpoint", F.col("request.location_code").alias("location_code"), F.col("request.language_code").alias("language_code")).agg(
        F.count("*").alias("results"), F.sum(F.size("result.items")).alias("n_items")
    )


@query("flatten_labs", _found("source_endpoint <> 'keywords_for_site'"))
def flatten_labs(spark, sf):
    return op.flatten_labs(discovery_raw(spark, sf)).drop("collected_at")


@query("flatten_site", _found("source_endpoint = 'keywords_for_site'"))
def flatten_site(spark, sf):
    return op.flatten_site(discovery_raw(spark, sf)).drop("collected_at")


@query("discovered_union", _found("true"))
def discovered_union(spark, sf):
    return op.discovered(discovery_raw(spark, sf)).drop("collected_at")


# -- volume -----------------------------------------------------------------------


def volume_raw(spark, sf):
    """One volume call per keyword and market; the result holds items or is the item."""
    m = fx.metrics(spark, sf, newest_first=False)
    listed = F.length("keyword") % 2 == 0
    fields = {
        "keyword": F.col("keyword"), "search_volume": F.col("search_volume"), "monthly_searches": F.col("monthly_searches"), "cpc": F.col("cpc"),
        "competition": F.coalesce(F.col("competition").cast("string"), F.lit("HIGH")), "competition_index": F.col("competition_index"),
    }
    item = F.struct(*[c.alias(n) for n, c in fields.items()])
    result = F.struct(F.when(listed, F.array(item)).alias("items"), *[F.when(~listed, c).alias(n) for n, c in fields.items()])
    request = F.struct(F.array("keyword").alias("keywords"), "location_code", "language_code")
    task = F.struct(F.lit(20000).alias("status_code"), F.array(result).alias("result"))
    envelope = F.struct(
        F.lit("/v3/ads/search_volume/live").alias("endpoint"), F.array(request).alias("request"),
        F.struct(F.lit(20000).alias("status_code"), F.array(task).alias("tasks")).alias("response"), "collected_at",
    )
    return raw_io.parse_raw(m.select(F.to_json(envelope).alias("value")))


@query("flatten_volume", f"""WITH {sql.DISC}, {sql.METRICS} SELECT keyword, location_code, language_code, search_volume, n_months::BIGINT AS n_months, v0 AS latest_month_searches,
    trend_3m, trend_12m, cpc, competition, competition_index FROM metrics_t""")
def flatten_volume(spark, sf):
    """Volume responses of a log on disk that holds result pages as well: only their folders are read."""
    log = new_folder(spark, "log")
    raw_io.append_raw(volume_raw(spark, sf), log)
    raw_io.append_raw(serp_pages(spark, sf), log)
    rows = op.flatten_volume(raw_io.read_raw(spark, log))
    return rows.select(
        "keyword", "location_code", "language_code", "search_volume", F.size("monthly_searches").cast("bigint").alias("n_months"),
        "latest_month_searches", "trend_3m", "trend_12m", "cpc", "competition", "competition_index",
    )


@query("monthly_series", f"""WITH {sql.DISC}, {sql.METRICS} SELECT keyword, location_code, language_code, i AS place, year, month, search_volume,
    first_value(search_volume) OVER (PARTITION BY keyword, location_code, language_code ORDER BY i) AS latest FROM metric_months""")
def monthly_series(spark, sf):
    unsorted = fx.metrics(spark, sf, newest_first=False).withColumn("m", series.sort_monthly("monthly_searches"))
    rows = unsorted.select(
        "keyword", "location_code", "language_code", series.latest_month("m").alias("latest"), F.posexplode("m").alias("place", "v")
    )
    return rows.select(
        "keyword", "location_code", "language_code", F.col("place").cast("bigint").alias("place"), F.col("v.year").cast("bigint").alias("year"),
        F.col("v.month").cast("bigint").alias("month"), "v.search_volume", "latest",
    )


@query("pct_trend", f"WITH {sql.DISC}, {sql.METRICS} SELECT keyword, location_code, language_code, trend_3m, trend_12m FROM metrics_t")
def pct_trend(spark, sf):
    return fx.with_trends(fx.metrics(spark, sf)).select("keyword", "location_code", "language_code", "trend_3m", "trend_12m")


# -- result pages -----------------------------------------------------------------

EVENT_TYPES = {"purchase": "shopping", "error": "people_also_ask", "view": "organic", "click": "video", "signup": "local_pack"}


def serp_pages(spark, sf):
    """Events as envelopes of result pages: one per user and run of 1000 events. A log takes them as they are."""
    part = fx.table(spark, sf, "part").select((F.col("p_partkey")).alias("_part"), "p_name")
    events = fx.table(spark, sf, "events").withColumn("_part", F.col("user_id") % fx.parts(spark, sf)).join(part, "_part")
    kind = F.when(F.lit(False), "")
    for event, name in EVENT_TYPES.items():
        kind = kind.when(F.col("event_type") == event, name)
    domain = F.when(kind == "organic", F.concat(F.lit("d"), (F.col("event_id") % 9).cast("string"), F.lit(".example")))
    item = F.struct("event_id", kind.alias("type"), domain.alias("domain"))
    # a run of event ids bounds the page
    pages = events.groupBy("user_id", "p_name", F.floor(F.col("event_id") / 1000).alias("run")).agg(
        F.sort_array(F.collect_list(item)).alias("found"), F.max(F.date_trunc("second", "ts")).alias("collected_at")
    )
    items = F.transform("found", lambda i: F.struct(i["type"].alias("type"), i["domain"].alias("domain")))
    task = F.struct(F.lit(20000).alias("status_code"), F.array(F.struct(items.alias("items"))).alias("result"))
    return pages.select(
        F.lit("/v3/serp/organic/live/advanced").alias("endpoint"), F.array(F.struct(F.col("p_name").alias("keyword"))).alias("request"),
        F.struct(F.lit(20000).alias("status_code"), F.array(task).alias("tasks")).alias("response"),
        F.col("collected_at").cast("timestamp").alias("collected_at"),
    )


def serp_raw(spark, sf):
    """The result pages as parsed JSON lines."""
    return raw_io.parse_raw(serp_pages(spark, sf).select(F.to_json(F.struct("*")).alias("value")))


SERP = """page_items AS (SELECT user_id, p_name AS keyword, event_id, event_id // 1000 AS run, date_trunc('second', ts) AS ts,
    CASE event_type WHEN 'purchase' THEN 'shopping' WHEN 'error' THEN 'people_also_ask' WHEN 'view' THEN 'organic' WHEN 'click' THEN 'video' ELSE 'local_pack' END AS type
    FROM events JOIN part ON p_partkey = user_id % (SELECT count(*) FROM part)),
  page_groups AS (SELECT keyword, max(ts) AS checked, list_sort(list_distinct(list(type))) AS f,
    list('d' || event_id % 9 || '.example' ORDER BY event_id) FILTER (WHERE type = 'organic') AS d FROM page_items GROUP BY user_id, keyword, run),
  serp AS (SELECT keyword, checked, CASE WHEN list_contains(f, 'shopping') THEN 'commercial' WHEN list_contains(f, 'people_also_ask') THEN 'informational'
    WHEN list_contains(f, 'video') THEN 'video' WHEN list_contains(f, 'local_pack') THEN 'local' ELSE 'navigational_or_mixed' END AS serp_intent,
    array_to_string(f, '|') AS serp_features, coalesce(array_to_string(d[1:5], '|'), '') AS serp_top_domains FROM page_groups)"""


@query("serp_features", f"WITH {SERP} SELECT keyword, serp_features, serp_top_domains FROM serp")
def serp_features(spark, sf):
    return op.flatten_serp(serp_raw(spark, sf)).select("keyword", "serp_features", "serp_top_domains")


@query("serp_intent", f"WITH {SERP} SELECT keyword, serp_intent, count(*) AS n FROM serp GROUP BY 1, 2")
def serp_intent(spark, sf):
    return op.flatten_serp(serp_raw(spark, sf)).groupBy("keyword", "serp_intent").agg(F.count("*").alias("n"))


LATEST_SERP = f"""{SERP}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY checked DESC, serp_intent DESC, serp_features DESC,
    serp_top_domains DESC) AS rn FROM serp) WHERE rn = 1)"""


@query("attach_serp", f"""WITH {sql.SCORED}, {LATEST_SERP} SELECT {KEY_SQL}, s.opportunity_score, l.serp_intent, l.serp_features, l.serp_top_domains
    FROM scored s LEFT JOIN latest l ON l.keyword = s.keyword_normalized""")
def attach_serp(spark, sf):
    master = scored(spark, sf).withColumns({"keyword": F.col("keyword_normalized"), "serp_intent": F.lit("old")})
    joined = enrich.attach_serp(master, op.flatten_serp(serp_raw(spark, sf)))
    return joined.select(*KEY, "opportunity_score", "serp_intent", "serp_features", "serp_top_domains")


@query("serp_stage", f"""WITH {sql.SCORED}, {LATEST_SERP}, asked AS (SELECT DISTINCT keyword_normalized AS keyword FROM scored WHERE rank < 2000)
    SELECT {KEY_SQL}, s.opportunity_score, l.serp_intent, l.serp_features, l.serp_top_domains
    FROM scored s LEFT JOIN (SELECT * FROM latest SEMI JOIN asked USING (keyword)) l ON l.keyword = s.keyword_normalized""")
def serp_stage(spark, sf):
    """The stage run twice on the table that it rewrites; the shortlist's length is its own parameter."""
    master, log = new_folder(spark, "master"), new_folder(spark, "log")
    write_version(scored(spark, sf).withColumn("keyword", F.col("keyword_normalized")), master)
    raw_io.append_raw(serp_pages(spark, sf), log)
    for _ in range(2):
        rows = stages.refresh_serp(spark, master, log, 2000)
    return rows.select(*KEY, "opportunity_score", "serp_intent", "serp_features", "serp_top_domains")


@query("label_counts", f"""WITH {sql.SCORED}, {LATEST_SERP} SELECT l.serp_intent, count(*) AS n FROM scored s LEFT JOIN latest l ON l.keyword = s.keyword_normalized GROUP BY 1""")
def label_counts(spark, sf):
    master = scored(spark, sf).withColumn("keyword", F.col("keyword_normalized"))
    return enrich.label_counts(enrich.attach_serp(master, op.flatten_serp(serp_raw(spark, sf))), "serp_intent")


# -- interest ---------------------------------------------------------------------

KINDS = ("click", "error", "purchase", "signup", "view")


def interest_raw(spark, sf):
    """Daily event counts as interest graphs: one call per group of users."""
    events = fx.table(spark, sf, "events")
    group = (F.col("user_id") % fx.parts(spark, sf)).alias("g")
    days = events.groupBy(group, F.to_date("ts").alias("day")).agg(
        *[F.nullif(F.count_if(F.col("event_type") == k), F.lit(0)).cast("double").alias(k) for k in KINDS]
    )
    point = F.struct("day", F.struct(F.array(*KINDS).alias("values")).alias("point"))
    # one point per calendar day
    graphs = days.groupBy("g").agg(F.transform(F.sort_array(F.collect_list(point)), lambda p: p["point"]).alias("data"))
    suffix = F.concat(F.lit(" g"), F.col("g").cast("string"))
    shown = F.array(*[F.concat(F.lit(k.upper()), suffix) for k in KINDS])
    asked = F.array(*[F.concat(F.lit(k), suffix) for k in (*KINDS, "other")])
    no_data = F.array().cast("array<struct<values:array<double>>>")
    items = F.array(
        F.struct(F.lit("google_trends_map").alias("type"), shown.alias("keywords"), F.col("data")),
        F.struct(F.lit("google_trends_graph").alias("type"), shown.alias("keywords"), no_data.alias("data")),
        F.struct(F.lit("google_trends_graph").alias("type"), shown.alias("keywords"), F.col("data")),
    )
    task = F.struct(F.lit(20000).alias("status_code"), F.array(F.struct(items.alias("items"))).alias("result"))
    envelope = F.struct(
        F.lit("/v3/trends/explore/live").alias("endpoint"), F.array(F.struct(asked.alias("keywords"))).alias("request"),
        F.struct(F.lit(20000).alias("status_code"), F.array(task).alias("tasks")).alias("response"),
    )
    return raw_io.parse_raw(graphs.select(F.to_json(envelope).alias("value")))


INTEREST = """asked AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'other']) AS kind),
  days AS (SELECT user_id % (SELECT count(*) FROM part) AS g, ts::DATE AS day, count(*) FILTER (WHERE event_type = 'click') AS clicks FROM events GROUP BY 1, 2),
  counts AS (SELECT user_id % (SELECT count(*) FROM part) AS g, ts::DATE AS day, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2, 3),
  points AS (SELECT kind || ' g' || g AS keyword, day, coalesce(n, nullif(clicks, 0))::DOUBLE AS v FROM days CROSS JOIN asked LEFT JOIN counts USING (g, day, kind)),
  interest AS (SELECT keyword, coalesce(list(v ORDER BY day) FILTER (WHERE v IS NOT NULL), []) AS vals FROM points GROUP BY 1),
  quarters AS (SELECT *, len(vals) AS n, greatest(1, len(vals) // 4) AS q FROM interest),
  trends AS (SELECT keyword, round_even(vals[n], 2) AS trend_interest_latest, round_even(list_avg(vals), 2) AS trend_interest_avg,
    CASE WHEN n > 0 THEN round_even(list_sum(vals[n - q + 1:n]) / q - list_sum(vals[1:q]) / q, 3) END AS trend_slope FROM quarters),
  directed AS (SELECT *, CASE WHEN trend_slope > 3 THEN 'rising' WHEN trend_slope < -3 THEN 'falling' WHEN trend_slope IS NOT NULL THEN 'flat' END AS trend_direction FROM trends)"""


@query("interest_series", f"WITH {INTEREST} SELECT keyword, len(vals)::BIGINT AS n, array_to_string(list_transform(vals, lambda x: x::BIGINT), '|') AS vals FROM interest")
def interest_series(spark, sf):
    rows = op.interest_series(interest_raw(spark, sf))
    shown = F.array_join(F.transform("values", lambda v: v.cast("bigint").cast("string")), "|")
    return rows.select("keyword", F.size("values").cast("bigint").alias("n"), shown.alias("vals"))


@query("interest_summary", f"WITH {INTEREST} SELECT keyword, trend_interest_latest, trend_interest_avg, trend_direction, trend_slope FROM directed")
def interest_summary(spark, sf):
    return op.trend_table(interest_raw(spark, sf)).drop("trend_checked_at")


@query("attach_trends", f"""WITH {sql.SCORED}, {INTEREST}, named AS (SELECT p_name, d.* FROM directed d JOIN part ON p_partkey = regexp_extract(d.keyword, 'g([0-9]+)$', 1)::BIGINT),
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY trend_interest_latest DESC NULLS LAST, trend_interest_avg DESC NULLS LAST,
      trend_direction DESC NULLS LAST, trend_slope DESC NULLS LAST) AS rn FROM named) WHERE rn = 1)
    SELECT {KEY_SQL}, l.trend_interest_latest, l.trend_interest_avg, l.trend_direction, l.trend_slope FROM scored s LEFT JOIN latest l ON l.p_name = s.keyword_normalized""")
def attach_trends(spark, sf):
    part = fx.table(spark, sf, "part").select(F.col("p_partkey").alias("_part"), "p_name")
    found = op.trend_table(interest_raw(spark, sf))
    number = F.regexp_extract("keyword", r"g([0-9]+)$", 1).cast("bigint")
    named = found.withColumn("_part", number).join(part, "_part").drop("_part", "keyword").withColumnRenamed("p_name", "keyword")
    master = scored(spark, sf).withColumn("keyword", F.col("keyword_normalized"))
    return enrich.attach_trends(master, named).select(*KEY, "trend_interest_latest", "trend_interest_avg", "trend_direction", "trend_slope")


# -- incremental ------------------------------------------------------------------


@contextmanager
def _discovery_lines(spark, sf):
    """The discovery log's lines, parsed and written down for as long as they are appended.

    Beside them there is no more on disk than one step's shuffle files and input.
    """
    with ExitStack() as kept:
        with passing_stage(fx.disc(spark, sf).drop("l_linenumber", "l_quantity", "p_name"), "found") as rows:
            raw = raw_io.parse_raw(discovery_log(spark, sf, rows))
            # sorted, like lines stand together and are packed together, here and on their way into the log
            made = raw_io.logged_lines(raw).sortWithinPartitions("log", "dt", "value")
            lines = kept.enter_context(passing_stage(made, "lines"))
        yield lines


def _logged(spark, sf, times=1):
    folder = new_folder(spark, "log")
    with _discovery_lines(spark, sf) as lines:
        for _ in range(times):
            raw_io.append_lines(lines, folder)
    return folder


@query("stream_intake", _found("true"))
def stream_intake(spark, sf):
    """The discovery logs of a folder that has others, too, taken in as a stream and flattened on the way."""
    sink, checkpoint, log = new_folder(spark, "discovered"), new_folder(spark, "stream"), _logged(spark, sf)
    raw_io.append_raw(serp_pages(spark, sf), log)
    intake.run_available(intake.stream_raw(spark, log, logs=KNOWN_LOGS), sink, checkpoint, op.discovered)
    return spark.read.schema(DISCOVERED).parquet(sink).drop("collected_at")


@query("stream_dedupe", f"""WITH {CALLS}, keyed AS (SELECT source_endpoint AS log,
      CASE source_endpoint WHEN 'keywords_for_site' THEN '{SITE}' WHEN 'keyword_ideas' THEN 'terms:' || sha1(source_term) ELSE source_term END AS subject,
      location_code, language_code, strftime(collected_at, '%Y-%m') AS bucket, collected_at FROM calls)
    SELECT log, subject, location_code, language_code, bucket, strftime(min(collected_at), '%Y-%m-%d %H:%M:%S') AS collected, 1::BIGINT AS responses
    FROM keyed GROUP BY log, subject, location_code, language_code, bucket""")
def stream_dedupe(spark, sf):
    """A log taken in by two runs, the later half of its responses first, then all of them; one per reuse key remains."""
    sink, checkpoint = new_folder(spark, "responses"), new_folder(spark, "stream")
    log = new_folder(spark, "log")
    with _discovery_lines(spark, sf) as lines:
        for part in (lines.where("collected_at >= '1995-07-01'"), lines):
            raw_io.append_lines(part, log)
            intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=200, shape=CALL_ENVELOPE, line=True), sink, checkpoint)
    kept = intake.kept_responses(raw_io.read_raw(spark, log, shape=CALL_ENVELOPE, line=True), intake.kept_keys(spark, sink))
    return kept.groupBy(*intake.REUSE_COLUMNS).agg(F.date_format(F.min("collected_at"), "yyyy-MM-dd HH:mm:ss").alias("collected"), F.count("*").alias("responses"))


@query("changed_and_gone", """SELECT doc_id, change, n_chars FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'gone' WHEN doc_id % 7 = 0 THEN 'new' ELSE 'changed' END AS change,
      CASE WHEN doc_id % 11 <> 0 THEN length(text) + CASE WHEN doc_id % 5 = 0 THEN 5 ELSE 0 END END::BIGINT AS n_chars
    FROM documents WHERE NOT (doc_id % 7 = 0 AND doc_id % 11 = 0) AND (doc_id % 11 = 0 OR doc_id % 7 = 0 OR doc_id % 5 = 0))""")
def changed_and_gone(spark, sf):
    """A run against the digests that the run before has kept: new, changed and vanished documents."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    content = ["text", "lang", "source"]
    kept = stage(intake.digests(docs.where("doc_id % 7 <> 0"), ["doc_id"], content), "digests")
    now = docs.where("doc_id % 11 <> 0").withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" more"))).otherwise(F.col("text")))
    rows = intake.changed_rows(now, kept, ["doc_id"], content, gone=True)
    return rows.select("doc_id", "change", F.length("text").cast("bigint").alias("n_chars"))


@query("changed_entities", """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'new' ELSE 'changed' END AS change FROM documents WHERE doc_id % 7 = 0 OR doc_id % 5 = 0""")
def changed_entities(spark, sf):
    old = fx.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    new = old.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" more"))).otherwise(F.col("text")))
    return intake.changed_entities(new, old.where("doc_id % 7 <> 0"), ["doc_id"], ["text", "lang", "source"]).select("doc_id", "change")
