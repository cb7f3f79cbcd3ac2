"""The registered queries of the operators, each over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, fim, fingerprint, html_region, language_id, line_dedup, ngram_join, ngram_lm, pieces, resample, toxicity, warc
from .shipping import ship
from .suffix_dedup import remove_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP2_SQL = """
WITH src AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS MATERIALIZED (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM src),
windows AS MATERIALIZED (
  SELECT doc_id, p, h[2 * p + 1 : 2 * p + 100] AS w FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS p FROM sized)
),
firsts AS (SELECT hash(w) AS k, min(doc_id) AS first_id FROM windows GROUP BY 1),
hits AS (SELECT s.doc_id, s.p FROM windows s JOIN firsts f ON hash(s.w) = f.k AND f.first_id < s.doc_id),
edges AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM hits),
marked AS (SELECT doc_id, p, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges),
spans AS (SELECT doc_id, run, min(p) AS b, max(p) + 50 AS e FROM marked GROUP BY 1, 2),
gaps AS (
  SELECT doc_id, run, b, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS before FROM spans
),
kept AS (
  SELECT g.doc_id, string_agg(s.h[2 * before + 1 : 2 * b], '' ORDER BY b) AS front, max(e) AS last, count(*) AS n_spans, sum(e - b) AS n_removed
  FROM gaps g JOIN sized s USING (doc_id) GROUP BY g.doc_id
)
SELECT s.doc_id, s.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN k.doc_id IS NULL THEN s.h ELSE k.front || s.h[2 * k.last + 1 :] END)) AS kept_sha256
FROM sized s LEFT JOIN kept k USING (doc_id)
"""


@_query("op2_suffix_array_dedup", OP2_SQL)
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=50).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op4_log_frequency_bloom_lm")
def op4_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    scored = ngram_lm.score_texts(docs, ~F.col("held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query("op1_factorization_machine_toxicity")
def op1_factorization_machine_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    machine = toxicity.learn(docs, labels)
    return toxicity.score_texts(docs.select("doc_id", "held_out", "text"), machine).select("doc_id", "held_out", "score", "predicted")


@_query("op10_token_combination_join")
def op10_token_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.link_documents(docs, size=4, percent=85).select("doc_id", "n_shingles", "component_id")


@_query("op6_kneser_ney_language_id")
def op6_kneser_ney_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    models = language_id.learn(docs, ~F.col("held_out"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), models).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


@_query("op7_warc_derivatives")
def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.derive(warc.responses(pages, date="2026-01-01T00:00:00Z"))


@_query("op9_maximum_region_html")
def op9_maximum_region_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = html_region.learn(pages)
    return html_region.main_text(pages, weights).select("page_id", "url", "text", "n_chars")


@_query("op8_one_permutation_minhash")
def op8_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint.fingerprints(docs).drop("text")


@_query("op3_shared_prefix_viterbi")
def op3_shared_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.load()).select("doc_id", "n_pieces", "ids", "decoded_sha256", "round_trip")


@_query("op5_pigeonhole_decontamination")
def op5_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


OP11_SQL = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, p, l, translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
),
often AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT l.doc_id, l.p, l.l, o.k IS NOT NULL AND l.doc_id <> o.keeper AS gone FROM lines l LEFT JOIN often o USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@_query("op11_line_bitmaps", OP11_SQL)
def op11_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_lines(docs, line_dedup.keep_bitmaps(docs)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP12_SQL = r"""
WITH src AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS d FROM documents
),
hashed AS (
  SELECT doc_id, t, u, len(u) AS n, CAST(('0x' || d[1:8]) AS BIGINT) AS h1, CAST(('0x' || d[9:16]) AS BIGINT) AS h2,
    CAST(('0x' || d[17:24]) AS BIGINT) AS h3, CAST(('0x' || d[25:32]) AS BIGINT) AS h4
  FROM src
),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM hashed),
parts AS (
  SELECT doc_id, t, n, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


@_query("op12_rank_index_fim", OP12_SQL)
def op12_rank_index_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.rewrite(docs, seed=7, rate=100, spm_rate=50).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@_query("op13_bracketed_resampling")
def op13_bracketed_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, _table(spark, sf_dir, "benchmark").select("text"), buckets=10_000, longest=1, least_words=20, percent=10, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
