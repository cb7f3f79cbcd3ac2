"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import normalize_keyword
from ..operators import merge, terms
from ..operators.pages import parse_pages
from ..sources.tables import spread_few_files

# How lineitem rows become keywords.
PREFIXES = ("", "why ", "how ", "buy ", "explain ", "free pdf ")
SUFFIXES = ("", " quiz", " summary", " chat", " facts", " analysis")


# Tables whose rows carry work: texts, pages and line items.
WORKED = ("documents", "pages", "conversations", "lineitem", "events")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread_few_files(df) if name in WORKED else df


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def pages_plus(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with description, canonical link, sub-headings and links of every kind."""
    page, url_host = F.col("page_id"), F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    ident = page.cast("string")
    head = (
        F.when(page % 5 == 0, F.lit("</head>"))
        .when(
            page % 2 == 0,
            F.concat(
                F.lit('<meta name="description" content=" About '), ident, F.lit(' &amp; more "><link rel="canonical" href="https://c.example/'),
                ident, F.lit('"></head>'),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("<meta content='Single "), ident, F.lit("' name='description'><link href=\"https://c.example/"),
                ident, F.lit('" rel="canonical"></head>'),
            )
        )
    )
    links = F.concat(
        F.lit('<a href="../up/x">u</a><a href="?q='), ident, F.lit('">q</a><a href="#f">f</a><a class="k" href=\'./s/'), ident,
        F.lit('\'>s</a><a href="//'), url_host, F.lit('/abs?a=1&amp;b=2#z">a</a><a href="mailto:a@b.example">m</a>'),
        F.lit('<a href="https://other.example/x">o</a><a name="n">n</a><a href="/a//b/../c/.">d</a></body>'),
    )
    html = F.replace(F.col("html"), F.lit("</head>"), head)
    html = F.replace(html, F.lit("<b>"), F.lit("<h2> Part <i>one</i> two</h2><H3 class=\"s\">Sub &amp; all</H3><b>"))
    html = F.replace(html, F.lit("</body>"), links)
    return table(spark, sf, "pages").select("page_id", "url", html.alias("html"))


def parts(spark: SparkSession, sf: str) -> Column:
    """Number of parts; part keys go from 0 to one less."""
    return table(spark, sf, "part").agg(F.count("*")).scalar()


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed pages as the page contract, with ``page_id`` as reading order."""
    return parse_pages(table(spark, sf, "pages"))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as entity rows; the other titles come from parts."""
    docs = table(spark, sf, "documents")
    part = table(spark, sf, "part").select((F.col("p_partkey")).alias("_part"), "p_name", "p_brand")
    rows = docs.withColumn("_part", F.col("doc_id") % parts(spark, sf)).join(part, "_part")
    ident = F.col("doc_id").cast("string")
    return rows.select(
        "doc_id",
        F.col("source").alias("entity_type"),
        ident.alias("entity_id"),
        "lang",
        F.concat(F.col("source"), F.lit(" "), ident).alias("title"),
        F.col("text").alias("description"),
        F.col("p_name").alias("base_text_title"),
        F.col("p_brand").alias("base_text_author"),
        F.when(F.col("doc_id") % 3 == 0, F.concat("p_name", F.lit("  contest"))).alias("contest_title"),
        F.concat(F.lit("https://e.example/"), ident).alias("public_url"),
        F.lit(None).cast("string").alias("created_at"),
    )


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return terms.union_candidates(
        terms.mine_pages(corpus(spark, sf), "page_id"), terms.mine_entities(entities(spark, sf), "doc_id")
    )


def disc(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as discovered keywords; ``ord`` is the input order."""
    line, part, supplier = (table(spark, sf, t) for t in ("lineitem", "part", "supplier"))
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    base = F.concat(pick(PREFIXES, F.col("l_partkey") % 6), F.col("p_name"), pick(SUFFIXES, F.col("l_suppkey") % 6))
    spelling = F.col("l_linenumber") % 3
    keyword = F.when(spelling == 0, F.upper(base)).when(spelling == 1, F.concat(F.lit("  "), base, F.lit(" !"))).otherwise(base)
    odd = F.col("l_linenumber") % 2 == 1
    endpoint = (
        F.when(F.col("l_returnflag") == "A", "keyword_suggestions")
        .when(F.col("l_returnflag") == "N", "related_keywords")
        .when(odd, "keyword_ideas")
        .otherwise("keywords_for_site")
    )
    level = F.when(F.col("p_size") <= 16, "LOW").when(F.col("p_size") <= 33, "MEDIUM").otherwise("HIGH")
    language = F.when(F.col("s_nationkey") != 24, F.when(F.col("s_nationkey") % 2 == 0, "en").otherwise("ru"))
    return rows.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
        "l_orderkey", "l_linenumber", "l_quantity", "p_name",
        keyword.alias("keyword"),
        F.col("p_brand").alias("source_term"),
        endpoint.alias("source_endpoint"),
        F.col("s_nationkey").alias("location_code"),
        language.alias("language_code"),
        (F.col("l_quantity") * 20).cast("bigint").alias("search_volume"),
        F.col("l_tax").alias("cpc"),
        F.when(F.col("l_quantity") != 1, F.col("l_discount") * 10).alias("competition"),
        level.alias("competition_level"),
        F.col("p_size").cast("double").alias("keyword_difficulty"),
        F.col("p_type").alias("categories"),
        F.col("l_shipdate").cast("timestamp").alias("collected_at"),
    )


def metrics(spark: SparkSession, sf: str, newest_first: bool = True) -> DataFrame:
    """Volume metrics per keyword and market, with a monthly series of 3 to 16 months.

    Rows are grouped by spelling first, so that a normal form is worked out per spelling, not per row.
    """
    rows = disc(spark, sf)
    month = F.year("collected_at") * 12 + F.month("collected_at") - 1
    spelled = rows.groupBy("keyword", "location_code", "language_code").agg(
        F.sum("l_quantity").alias("q"), F.count("*").alias("n"), F.max(month).alias("base"), F.max("collected_at").alias("collected_at")
    )
    grouped = spelled.groupBy(normalize_keyword("keyword").alias("keyword"), "location_code", "language_code").agg(
        F.sum("q").cast("bigint").alias("q"), F.sum("n").alias("n"), F.max("base").alias("base"), F.max("collected_at").alias("collected_at")
    )
    q = F.col("q")

    def one(i: Column) -> Column:
        at = F.col("base") - i
        volume = ((q * (i + 3) + F.col("n")) % 17 * 10).cast("bigint")
        return F.struct(
            F.floor(at / 12).cast("int").alias("year"), (at % 12 + 1).cast("int").alias("month"), volume.alias("search_volume")
        )

    last = (q % 14 + 2).cast("int")
    steps = F.sequence(F.lit(0), last) if newest_first else F.sequence(last, F.lit(0))
    return grouped.select(
        "keyword", "location_code", "language_code",
        F.when(q % 7 != 0, q % 23 * 100).alias("search_volume"),
        F.transform(steps, one).alias("monthly_searches"),
        F.when(q % 5 != 0, q % 100 / 10).alias("cpc"),
        F.when(q % 4 != 0, q % 11 / 10).alias("competition"),
        (q % 100).cast("double").alias("competition_index"),
        "collected_at",
    )


def with_trends(df: DataFrame) -> DataFrame:
    from ..functions.series import latest_month, pct_trend

    return df.withColumns(
        {
            "latest_month_searches": latest_month("monthly_searches"),
            "trend_3m": pct_trend("monthly_searches", 3),
            "trend_12m": pct_trend("monthly_searches", 12),
        }
    )


def known_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Entity candidates among the part names; headings must not count."""
    part = table(spark, sf, "part").select("p_name").distinct()
    last = F.element_at(F.split("p_name", " "), -1)
    book = part.where(last.isin("ring", "bolt", "gear")).select(F.initcap("p_name").alias("term"), F.lit("book_title").alias("term_type"))
    word = part.where(last == "anvil").select(last.alias("term"), F.lit("character").alias("term_type")).distinct()
    heading = part.where(last == "gizmo").select(F.col("p_name").alias("term"), F.lit("heading").alias("term_type"))
    return book.unionByName(word).unionByName(heading)


def master(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_keywords(disc(spark, sf), with_trends(metrics(spark, sf)), "ord")
