"""Merging, identity, containment, scoring, ranking, clusters, enrichment, reports."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..config import LANGUAGES, NEGATIVE_CATEGORIES
from ..functions import scoring
from ..functions.text import normalize_keyword
from ..operators import cluster, containment, enrich, merge, report, score as sc, terms
from ..session import new_folder, stage
from ..sources.tables import export_clusters, export_opportunities
from . import fixtures as fx, sql
from .registry import query

KEY = ("keyword_normalized", "location_code", "language_code")
KEY_SQL = ", ".join(KEY)


@query("normalize_keyword", f"WITH {sql.DISC} SELECT keyword, keyword_normalized, count(*) AS n FROM disc_n GROUP BY 1, 2")
def normalize(spark, sf):
    rows = fx.disc(spark, sf).groupBy("keyword").agg(F.count("*").alias("n"))
    return rows.withColumn("keyword_normalized", normalize_keyword("keyword"))


MERGED_COLUMNS = (*KEY, "keyword", "search_volume", "cpc", "competition", "competition_level", "keyword_difficulty", "source_terms",
                  "source_endpoints", "categories", "source_urls")


@query("merge_discovered", f"WITH {sql.DISC}, {sql.MERGED} SELECT * REPLACE (search_volume::DOUBLE AS search_volume) FROM merged")
def merge_discovered(spark, sf):
    return merge.merge_discovered(fx.disc(spark, sf), "ord").select(*MERGED_COLUMNS)


@query("join_unique", f"""WITH {sql.DISC} SELECT p_name, location_code, {sql.unique_list('source_term')} AS source_terms,
    {sql.unique_list('categories')} AS categories, {sql.unique_list('keyword')} AS keywords FROM disc GROUP BY 1, 2""")
def join_unique(spark, sf):
    rows = fx.disc(spark, sf)
    return rows.groupBy("p_name", "location_code").agg(
        merge.join_unique("source_term").alias("source_terms"), merge.join_unique("categories").alias("categories"),
        merge.join_unique("keyword").alias("keywords"),
    )


DUPLICATED = """doubled AS (SELECT *, 1 AS copy FROM metrics_t UNION ALL
    SELECT * REPLACE (upper(keyword) AS keyword, 7777 AS search_volume, collected_at + INTERVAL 1 DAY AS collected_at), 2 AS copy FROM metrics_t)"""


def _doubled(spark, sf):
    rows = fx.with_trends(fx.metrics(spark, sf))
    later = rows.withColumns(
        {"keyword": F.upper("keyword"), "search_volume": F.lit(7777).cast("bigint"), "collected_at": F.col("collected_at") + F.expr("INTERVAL 1 DAY")}
    )
    return rows.unionByName(later)


@query("dedupe_metrics", f"""WITH {sql.DISC}, {sql.METRICS}, {DUPLICATED} SELECT {sql.norm('keyword')} AS keyword_normalized, location_code, language_code,
    search_volume::DOUBLE AS search_volume, cpc, competition, trend_3m, trend_12m, competition_index FROM doubled WHERE copy = 1""")
def dedupe_metrics(spark, sf):
    kept = merge.dedupe_metrics(_doubled(spark, sf), "collected_at")
    return kept.drop("monthly_searches").withColumn("search_volume", F.col("search_volume").cast("double"))


MASTER_SQL = f"""{KEY_SQL}, keyword, keyword_id, search_volume, cpc, competition, competition_level, keyword_difficulty, source_terms, source_endpoints,
    categories, source_urls, trend_3m, trend_12m, competition_index"""


@query("attach_metrics", f"WITH {sql.MASTER} SELECT * EXCLUDE (keyword_id) FROM (SELECT {MASTER_SQL}, coalesce(n_months, -1)::BIGINT AS n_months FROM master)")
def attach_metrics(spark, sf):
    merged = merge.merge_discovered(fx.disc(spark, sf), "ord")
    rows = merge.attach_metrics(merged, _doubled(spark, sf))
    return rows.withColumn("n_months", F.coalesce(F.size("monthly_searches"), F.lit(-1)).cast("bigint")).drop("monthly_searches")


@query("keyword_id", f"WITH {sql.MASTER} SELECT {KEY_SQL}, keyword_id FROM master")
def keyword_id(spark, sf):
    return fx.master(spark, sf).select(*KEY, "keyword_id")


@query("merge_keywords", f"WITH {sql.MASTER} SELECT {MASTER_SQL} FROM master")
def merge_keywords(spark, sf):
    return fx.master(spark, sf).drop("monthly_searches")


@query("resolve_sources", f"""WITH {sql.ENTITY_CANDIDATES}, {sql.DISC},
    u AS (SELECT {sql.strip('lower(term)')} AS t, array_to_string(list_sort(list_distinct(list(source_url))), '|') AS urls FROM ent_cand WHERE source_url <> '' GROUP BY 1),
    p AS (SELECT * REPLACE (CASE WHEN l_linenumber % 2 = 1 THEN upper(p_name) ELSE p_name END AS source_term) FROM disc_n)
    SELECT {KEY_SQL}, array_to_string(list_sort(list_distinct(flatten(list(string_split(urls, '|'))))), '|') AS source_urls FROM (
      SELECT p.*, coalesce(u.urls, '') AS urls FROM p LEFT JOIN u ON u.t = lower(trim(p.source_term))) GROUP BY {KEY_SQL}""")
def resolve_sources(spark, sf):
    odd = F.col("l_linenumber") % 2 == 1
    rows = fx.disc(spark, sf).withColumn("source_term", F.when(odd, F.upper("p_name")).otherwise(F.col("p_name")))
    found = merge.resolve_sources(rows, terms.mine_entities(fx.entities(spark, sf), "doc_id"))
    return merge.merge_discovered(found, "ord").select(*KEY, "source_urls")


# -- entities ---------------------------------------------------------------------


@query("entity_set", f"WITH {sql.KNOWN} SELECT entity FROM known")
def entity_set(spark, sf):
    return containment.entity_set(fx.known_terms(spark, sf))


@query("entity_containment", f"WITH {sql.DISC}, {sql.KNOWN}, k AS (SELECT DISTINCT lower(keyword) AS keyword FROM disc) SELECT keyword, entity FROM k JOIN known ON contains(keyword, entity)")
def entity_containment(spark, sf):
    return containment.entity_containment(fx.disc(spark, sf), containment.entity_set(fx.known_terms(spark, sf)))


@query("mined_containment", f"""WITH {sql.CORPUS_CANDIDATES}, e AS (SELECT DISTINCT {sql.strip('lower(term)')} AS entity FROM page_cand
      WHERE term_type IN ('book_title', 'author', 'character', 'historical_person', 'page_title')), k AS (SELECT DISTINCT lower(term) AS keyword FROM page_cand WHERE term_type = 'heading' OR term_type = 'page_title')
    SELECT keyword, entity FROM k JOIN e ON length(entity) >= 3 AND contains(keyword, entity)""")
def mined_containment(spark, sf):
    """Mined entities of the whole corpus inside its titles and headings."""
    cand = stage(terms.mine_pages(fx.corpus(spark, sf), "page_id"), "candidates")
    texts = cand.where(F.col("term_type").isin("heading", "page_title")).withColumnRenamed("term", "keyword")
    return containment.entity_containment(texts, containment.entity_set(cand))


# -- scoring ----------------------------------------------------------------------


@query("coerce_numeric", f"""WITH {sql.DISC}, t AS (SELECT ord, CASE WHEN l_linenumber = 1 THEN 'HIGH' WHEN l_linenumber = 2 THEN 'NaN' ELSE competition::VARCHAR END AS c,
      search_volume::VARCHAR AS v FROM disc)
    SELECT ord, CASE WHEN c NOT IN ('HIGH', 'NaN') THEN c::DOUBLE END AS competition, v::DOUBLE AS search_volume, NULL::DOUBLE AS trend_3m FROM t""")
def coerce_numeric(spark, sf):
    number = F.col("l_linenumber")
    shown = F.when(number == 1, "HIGH").when(number == 2, "NaN").otherwise(F.col("competition").cast("string"))
    rows = fx.disc(spark, sf).select("ord", shown.alias("competition"), F.col("search_volume").cast("string").alias("search_volume"))
    return sc.coerce_numeric(rows)


def _kw():
    return F.lower("keyword"), F.col("language_code")


def _master_query(name, sql_column, column, expression, base=sql.MASTER + ", " + sql.SIGNALS, source="signals"):
    @query(name, f"WITH {base} SELECT {KEY_SQL}, {sql_column} AS {column} FROM {source}")
    def run(spark, sf):
        return fx.master(spark, sf).select(*KEY, expression().alias(column))


_master_query("lang_signals", "signal_language", "signal_language", lambda: scoring.signal_language("language_code", LANGUAGES))
_master_query("question_intent", "question", "question_intent_score", lambda: scoring.question_intent(*_kw(), LANGUAGES), sql.SCORED, "parts")
_master_query("intent_label", "intent_label", "intent_label", lambda: scoring.intent_label(*_kw(), LANGUAGES), sql.SCORED, "parts")
_master_query("low_competition", "competition_score", "low_competition", lambda: scoring.low_competition("competition"), sql.SCORED, "components")
_master_query("trend_score", "trend_score", "trend_score", lambda: scoring.trend_score("trend_3m"), sql.SCORED, "components")


@query("negative_filter", f"WITH {sql.SCORED} SELECT {KEY_SQL}, negative AS category, multiplier, dropped FROM components")
def negative_filter(spark, sf):
    rows = fx.master(spark, sf).withColumn("category", scoring.negative_category(F.lower("keyword"), NEGATIVE_CATEGORIES))
    category = F.col("category")
    return rows.select(
        *KEY, "category", scoring.negative_multiplier(category, NEGATIVE_CATEGORIES).alias("multiplier"),
        scoring.is_dropped(category, NEGATIVE_CATEGORIES).alias("dropped"),
    )


@query("log_volume", f"WITH {sql.SCORED} SELECT {KEY_SQL}, round(volume_score, 9) AS log_volume FROM components")
def log_volume(spark, sf):
    rows = stage(fx.master(spark, sf).select(*KEY, "search_volume"), "volumes")
    return rows.select(*KEY, F.round(scoring.log_volume("search_volume", sc.largest_volume(rows)), 9).alias("log_volume"))


def _entities(spark, sf):
    return containment.entity_set(fx.known_terms(spark, sf))


@query("relevance", f"WITH {sql.SCORED} SELECT {KEY_SQL}, relevance AS relevance_score, content_available FROM parts")
def relevance(spark, sf):
    rows = containment.with_longest_entity(stage(fx.master(spark, sf).select(*KEY, "keyword"), "keywords"), _entities(spark, sf))
    hit = F.col("entity").isNotNull()
    return rows.select(*KEY, scoring.relevance(F.lower("keyword"), hit, F.col("language_code"), LANGUAGES).alias("relevance_score"), hit.alias("content_available"))


@query("lexical_cluster", f"WITH {sql.SCORED} SELECT {KEY_SQL}, cluster_label FROM scored")
def lexical_cluster(spark, sf):
    rows = containment.with_longest_entity(stage(fx.master(spark, sf).select(*KEY, "keyword"), "keywords"), _entities(spark, sf))
    return rows.select(*KEY, scoring.lexical_cluster(F.lower("keyword"), F.col("entity")).alias("cluster_label"))


def scored(spark, sf):
    """The scored master: merged, written as a stage table, scored from there."""
    return sc.score(stage(fx.master(spark, sf), "master"), entities=_entities(spark, sf))


SCORED_SQL = f"""{MASTER_SQL}, relevance_score, question_intent_score, opportunity_score, intent_label, cluster_label, content_available,
    passes_filters, recommended_action"""


@query("score_keywords", f"WITH {sql.SCORED} SELECT {SCORED_SQL} FROM scored")
def score_keywords(spark, sf):
    return scored(spark, sf).drop("monthly_searches")


@query("opportunity", f"WITH {sql.SCORED} SELECT {KEY_SQL}, opportunity_score FROM scored")
def opportunity(spark, sf):
    return scored(spark, sf).select(*KEY, "opportunity_score")


@query("recommend_action", f"""WITH {sql.MASTER}, a AS (SELECT {KEY_SQL}, search_volume, coalesce(competition, 0) AS opportunity_score, coalesce(cpc, 0) * 10 AS relevance_score,
      coalesce(trend_3m, 0) AS question_intent_score, competition_level = 'HIGH' AS content_available, competition_level = 'LOW' AND search_volume > 900 AS dropped FROM master)
    SELECT {KEY_SQL}, CASE WHEN dropped THEN 'ignore_irrelevant' WHEN opportunity_score >= 0.75::DOUBLE AND NOT content_available THEN 'create_landing_page'
      WHEN opportunity_score >= 0.6::DOUBLE AND content_available THEN 'add_faq_to_existing_page' WHEN question_intent_score >= 0.6::DOUBLE AND NOT content_available THEN 'create_chat'
      WHEN relevance_score >= 0.6::DOUBLE AND coalesce(search_volume, 0) >= 100 THEN 'create_quiz' WHEN content_available AND opportunity_score >= 0.4::DOUBLE THEN 'improve_title_meta'
      WHEN opportunity_score >= 0.2::DOUBLE THEN 'monitor_only' ELSE 'ignore_irrelevant' END AS recommended_action FROM a""")
def recommend_action(spark, sf):
    """Stand-in scores spread over all rules; the scoring query checks the real ones."""
    zero = F.lit(0.0)
    rows = fx.master(spark, sf).select(
        *KEY, "search_volume", F.coalesce("competition", zero).alias("opportunity_score"), (F.coalesce("cpc", zero) * 10).alias("relevance_score"),
        F.coalesce("trend_3m", zero).alias("question_intent_score"), (F.col("competition_level") == "HIGH").alias("content_available"),
        F.coalesce((F.col("competition_level") == "LOW") & (F.col("search_volume") > 900), F.lit(False)).alias("dropped"),
    )
    return sc.recommend_action(rows, "dropped").select(*KEY, "recommended_action")


@query("passes_filters", f"WITH {sql.SCORED} SELECT {KEY_SQL}, passes_filters FROM scored")
def passes_filters(spark, sf):
    rows = fx.master(spark, sf).withColumn("category", scoring.negative_category(F.lower("keyword"), NEGATIVE_CATEGORIES))
    return rows.select(*KEY, sc.passes_filters(scoring.is_dropped(F.col("category"), NEGATIVE_CATEGORIES)).alias("passes_filters"))


@query("rank_master", f"WITH {sql.SCORED} SELECT rank, {KEY_SQL}, opportunity_score, passes_filters FROM scored")
def rank_master(spark, sf):
    narrow = scored(spark, sf).select(*KEY, "opportunity_score", "passes_filters")
    return sc.rank_master(narrow).select("rank", *KEY, "opportunity_score", "passes_filters")


# -- clusters ---------------------------------------------------------------------


@query("tfidf_chars", f"""WITH d AS (SELECT DISTINCT p_name AS keyword FROM part), w AS (SELECT keyword, ' ' || unnest(string_split(lower(keyword), ' ')) || ' ' AS w FROM d),
    g AS (SELECT keyword, substr(w, i, n) AS gram FROM (SELECT keyword, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM w, (SELECT unnest([2, 3, 4]) AS n))),
    tf AS (SELECT keyword, gram, count(*) AS tf FROM g GROUP BY ALL), df AS (SELECT gram, count(*) AS df FROM tf GROUP BY 1),
    x AS (SELECT keyword, gram, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM d)) / (1.0::DOUBLE + df)) + 1) AS w FROM tf JOIN df USING (gram))
    SELECT keyword, gram, round(w / sqrt(sum(w * w) OVER (PARTITION BY keyword)), 6) AS weight FROM x""")
def tfidf_chars(spark, sf):
    names = fx.table(spark, sf, "part").select(F.col("p_name").alias("keyword")).distinct()
    return cluster.tfidf_chars(names, "keyword", "keyword").select("keyword", "gram", F.round("weight", 6).alias("weight"))


@query("choose_k", """SELECT p_name, count(*) AS n, greatest(2, least(12, count(*) // 3))::BIGINT AS k FROM part GROUP BY 1""")
def choose_k(spark, sf):
    sizes = fx.table(spark, sf, "part").groupBy("p_name").agg(F.count("*").alias("n"))
    return sizes.withColumn("k", cluster.cluster_count(F.col("n")))


def _vectors(spark, sf):
    names = fx.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("keyword"))
    rows = fx.table(spark, sf, "embeddings").withColumn("p_partkey", F.col("vec_id") % fx.parts(spark, sf)).join(names, "p_partkey")
    return rows.select("vec_id", "embedding", "label", "keyword", (F.col("vec_id") % 17).alias("search_volume"))


@query("dense_vectors", """WITH v AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings)
    SELECT vec_id, unnest(range(len(embedding)))::BIGINT AS place, round(unnest(list_transform(embedding, lambda x: x::DOUBLE / norm)), 9) AS value FROM v""")
def dense_vectors(spark, sf):
    rows = cluster.dense_vectors(fx.table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    values = rows.select("vec_id", F.posexplode(vector_to_array("vector")).alias("place", "value"))
    return values.select("vec_id", F.col("place").cast("bigint").alias("place"), F.round("value", 9).alias("value"))


@query("grouped_names", """WITH n AS (SELECT count(*) AS rows_, count(DISTINCT p_name) AS names FROM part)
    SELECT p_name AS keyword, count(*) AS rows, 1::BIGINT AS clusters, (SELECT least(names, greatest(2, least(12, rows_ // 3))) FROM n)::BIGINT AS clusters_of_all FROM part GROUP BY 1""")
def grouped_names(spark, sf):
    """Part names grouped from the bottom up: as many clusters as the rule says, and rows of one name together."""
    grouped = stage(cluster.group_texts(fx.table(spark, sf, "part").select(F.col("p_name").alias("keyword")), "keyword"), "grouped")
    total = grouped.agg(F.countDistinct("cluster_id")).scalar()
    return grouped.groupBy("keyword").agg(F.count("*").alias("rows"), F.countDistinct("cluster_id").alias("clusters")).withColumn("clusters_of_all", total)


@query("semantic_clusters")
def semantic_clusters(spark, sf):
    rows = cluster.dense_vectors(_vectors(spark, sf), "embedding")
    return cluster.assign_clusters(rows).select("vec_id", "cluster_id")


@query("semantic_keyword_clusters")
def semantic_keyword_clusters(spark, sf):
    rows = stage(scored(spark, sf).drop("monthly_searches"), "scored")
    labelled = cluster.semantic_labels(rows, _entities(spark, sf), "keyword_normalized")
    return labelled.select("keyword", "cluster_label")


@query("cluster_names", f"""WITH {sql.KNOWN}, v AS (SELECT vec_id, label, p_name AS keyword, vec_id % 17 AS v FROM embeddings JOIN part ON p_partkey = vec_id % (SELECT count(*) FROM part)),
    b AS (SELECT label, arg_min(keyword, vec_id - v * 1000000000) AS keyword, count(*) AS members FROM v GROUP BY 1)
    SELECT label, members, coalesce((SELECT arg_min(entity, {{'n': -length(entity), 'e': entity}}) FROM known WHERE contains(keyword, entity)), keyword) AS cluster_label FROM b""")
def cluster_names(spark, sf):
    return cluster.name_clusters(_vectors(spark, sf), "label", _entities(spark, sf), "vec_id")


# -- reports ----------------------------------------------------------------------


@query("shortlist", f"WITH {sql.SCORED} SELECT keyword FROM scored WHERE rank < 25")
def shortlist(spark, sf):
    return enrich.shortlist(scored(spark, sf), 25)


@query("opportunity_export", f"""WITH {sql.SCORED} SELECT keyword, language_code, location_code, search_volume, trend_3m, trend_12m, competition, NULL::DOUBLE AS cpc,
    source_terms, source_urls, intent_label, cluster_label, relevance_score, opportunity_score, recommended_action FROM scored""")
def opportunity_export(spark, sf):
    return export_opportunities(scored(spark, sf).drop("cpc"))


@query("summary_totals", f"WITH {sql.SCORED} SELECT count(*) AS keywords, count(*) FILTER (WHERE search_volume > 0) AS with_volume, count(*) FILTER (WHERE passes_filters) AS passing FROM scored")
def summary_totals(spark, sf):
    return report.summary_totals(scored(spark, sf))


@query("top_languages", f"WITH {sql.SCORED} SELECT language_code, count(*) AS keywords FROM scored WHERE language_code IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_languages(spark, sf):
    return report.top_languages(scored(spark, sf))


@query("top_clusters", f"WITH {sql.SCORED} SELECT cluster_label, count(*) AS keywords FROM scored GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8")
def top_clusters(spark, sf):
    return report.top_clusters(scored(spark, sf))


@query("top_opportunities", f"""WITH {sql.SCORED} SELECT keyword, language_code, location_code, search_volume, trend_3m, trend_12m, competition, cpc, source_terms, source_urls,
    intent_label, cluster_label, relevance_score, opportunity_score, recommended_action FROM scored WHERE rank < 500""")
def top_opportunities(spark, sf):
    return report.top_opportunities(scored(spark, sf), 500)


@query("volume_vs_competition", f"""WITH {sql.SCORED} SELECT keyword, location_code, language_code, cluster_label, search_volume, coalesce(competition, 0) AS competition,
    greatest(coalesce(trend_3m, 0), 0) + 0.1::DOUBLE AS trend_size, source_terms, opportunity_score, recommended_action FROM scored WHERE search_volume > 0""")
def volume_vs_competition(spark, sf):
    return report.volume_vs_competition(scored(spark, sf))


@query("trend_matrix", f"""WITH {sql.SCORED}, top AS (SELECT * FROM scored ORDER BY opportunity_score DESC, rank LIMIT 20),
    m AS (SELECT t.keyword, t.keyword_normalized, t.location_code, t.language_code, list(m.search_volume ORDER BY i DESC) FILTER (WHERE i < 12) AS v FROM top t
      JOIN metric_months m ON m.keyword = t.keyword_normalized AND m.location_code IS NOT DISTINCT FROM t.location_code AND m.language_code IS NOT DISTINCT FROM t.language_code
      GROUP BY ALL),
    k AS (SELECT *, max(len(v)) OVER () AS width FROM m WHERE list_max(v) <> 0)
    SELECT substr(keyword, 1, 40) AS label, {KEY_SQL}, i AS month_no, coalesce(v[i + 1], 0)::BIGINT AS volume FROM (SELECT *, unnest(range(width)) AS i FROM k)""")
def trend_matrix(spark, sf):
    matrix = report.trend_matrix(scored(spark, sf))
    rows = matrix.select("label", *KEY, F.posexplode("volumes").alias("month_no", "volume"))
    return rows.withColumn("month_no", F.col("month_no").cast("bigint"))


@query("cluster_summary", f"""WITH {sql.SCORED} SELECT cluster_label, count(keyword) AS keywords, coalesce(sum(search_volume), 0) AS total_volume,
    sum(competition::DECIMAL(26, 12))::DOUBLE / nullif(count(competition), 0) AS avg_competition,
    sum(opportunity_score::DECIMAL(26, 12))::DOUBLE / count(opportunity_score) AS avg_opportunity, arg_min(keyword, rank) AS best_keyword FROM scored GROUP BY 1""")
def cluster_summary(spark, sf):
    return report.cluster_summary(scored(spark, sf))


@query("cluster_export", f"""WITH {sql.SCORED} SELECT cluster_label, count(keyword) AS keywords, coalesce(sum(search_volume), 0) AS total_volume,
    sum(competition::DECIMAL(26, 12))::DOUBLE / nullif(count(competition), 0) AS avg_competition,
    sum(opportunity_score::DECIMAL(26, 12))::DOUBLE / count(opportunity_score) AS avg_opportunity, arg_min(keyword, rank) AS best_keyword FROM scored GROUP BY 1""")
def cluster_export(spark, sf):
    """The cluster summary written as a report file and read back."""
    folder, summary = new_folder(spark, "clusters"), report.cluster_summary(scored(spark, sf))
    export_clusters(summary, folder)
    return spark.read.schema(summary.schema).options(header=True, quote='"', escape='"', multiLine=True).csv(folder)


KNOWN_CODES = (2840, 2826, 2376, 2643)


@query("top_markets", f"""WITH {sql.SCORED}, m AS (SELECT {list(KNOWN_CODES)}[(location_code % 4) + 1] AS location_code, language_code FROM scored)
    SELECT location_code, language_code, count(*) AS keywords, CASE WHEN location_code = 2840 AND language_code = 'en' THEN 'United States'
      WHEN location_code = 2826 AND language_code = 'en' THEN 'United Kingdom' WHEN location_code = 2376 AND language_code = 'en' THEN 'Israel (English)'
      WHEN location_code = 2376 AND language_code = 'ru' THEN 'Israel (Russian)' WHEN location_code = 2643 AND language_code = 'ru' THEN 'Russia' END AS name
    FROM m GROUP BY 1, 2""")
def top_markets(spark, sf):
    codes = F.array(*[F.lit(c) for c in KNOWN_CODES])
    located = scored(spark, sf).withColumn("location_code", F.element_at(codes, F.col("location_code") % 4 + 1))
    return report.top_markets(located)


@query("action_report", f"""WITH {sql.SCORED} SELECT recommended_action, count(*) AS keywords, coalesce(sum(search_volume), 0) AS total_volume,
    max(opportunity_score) AS best_opportunity, arg_min(keyword, rank) AS best_keyword FROM scored GROUP BY 1""")
def action_report(spark, sf):
    return report.action_report(scored(spark, sf))
