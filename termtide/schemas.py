"""Declared table contracts; nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, TIME = T.BooleanType(), T.TimestampType()


def _fields(names: str, dtype: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, dtype) for name in names.split()]


def _struct(*groups: list[T.StructField]) -> T.StructType:
    return T.StructType([field for group in groups for field in group])


MONTHS = T.ArrayType(_struct(_fields("year month", INT), _fields("search_volume", BIGINT)))

PAGES = _struct(
    _fields("url lang title meta_description h1 h2 h3 body_text content_type course_id reading_id echo_id", STRING),
    _fields("internal_links", T.ArrayType(STRING)),
    _fields("created_at", TIME),
)

ENTITIES = _struct(
    _fields(
        "entity_type entity_id lang title description base_text_title base_text_author contest_title public_url created_at",
        STRING,
    )
)

CANDIDATES = _struct(
    _fields("term source_url source_entity_type source_entity_id lang term_type", STRING),
    _fields("term_count", BIGINT),
    _fields("source_title extraction_method", STRING),
)

DISCOVERED = _struct(
    _fields("keyword source_term source_endpoint", STRING),
    _fields("location_code", INT),
    _fields("language_code", STRING),
    _fields("search_volume", BIGINT),
    _fields("cpc competition", DOUBLE),
    _fields("competition_level", STRING),
    _fields("keyword_difficulty", DOUBLE),
    _fields("categories", STRING),
    _fields("collected_at", TIME),
)

METRICS = _struct(
    _fields("keyword", STRING),
    _fields("location_code", INT),
    _fields("language_code", STRING),
    _fields("search_volume", BIGINT),
    _fields("monthly_searches", MONTHS),
    _fields("latest_month_searches", BIGINT),
    _fields("trend_3m trend_12m cpc competition competition_index low_top_of_page_bid high_top_of_page_bid", DOUBLE),
    _fields("collected_at", TIME),
)

SERP_INTENT = _struct(_fields("keyword serp_intent serp_features serp_top_domains", STRING), _fields("serp_checked_at", TIME))

TREND_TABLE = _struct(
    _fields("keyword", STRING),
    _fields("trend_interest_latest trend_interest_avg", DOUBLE),
    _fields("trend_direction", STRING),
    _fields("trend_slope", DOUBLE),
    _fields("trend_checked_at", TIME),
)

# One logged call: every response shape the flatteners read, in one nested type.
# ``competition`` is text because one endpoint reports a level there, not a number.
_INFO_FIELDS = (
    _fields("search_volume", BIGINT), _fields("cpc", DOUBLE), _fields("competition competition_level", STRING),
    _fields("categories", T.ArrayType(STRING)),
)
_INFO = _struct(_fields("keyword", STRING), *_INFO_FIELDS)
_PROPERTIES = _struct(_fields("keyword_difficulty", DOUBLE))
_VOLUME_FIELDS = (
    _fields("monthly_searches", MONTHS), _fields("competition_index low_top_of_page_bid high_top_of_page_bid", DOUBLE),
)
_ITEM = _struct(
    _fields("keyword", STRING),
    _fields("keyword_data", _struct(_fields("keyword", STRING), _fields("keyword_info", _INFO), _fields("keyword_properties", _PROPERTIES))),
    _fields("keyword_info", _INFO),
    _fields("keyword_properties", _PROPERTIES),
    *_INFO_FIELDS,
    *_VOLUME_FIELDS,
    _fields("type domain", STRING),
    _fields("keywords", T.ArrayType(STRING)),
    _fields("data", T.ArrayType(_struct(_fields("values", T.ArrayType(DOUBLE))))),
)
_RESULT = _struct(
    _fields("items", T.ArrayType(_ITEM)),
    _fields("keyword", STRING),
    _fields("search_volume", BIGINT),
    _fields("cpc", DOUBLE),
    _fields("competition", STRING),
    *_VOLUME_FIELDS,
)
_REQUEST = _struct(
    _fields("keyword", STRING),
    _fields("keywords", T.ArrayType(STRING)),
    _fields("target", STRING),
    _fields("location_code", INT),
    _fields("language_code", STRING),
    _fields("depth limit", INT),
    _fields("time_range", STRING),
)
_TASK = _struct(_fields("status_code", INT), _fields("status_message", STRING), _fields("result", T.ArrayType(_RESULT)))
_RESPONSE = _struct(_fields("status_code", INT), _fields("status_message", STRING), _fields("tasks", T.ArrayType(_TASK)))
ENVELOPE = _struct(
    _fields("endpoint", STRING), _fields("request", T.ArrayType(_REQUEST)), _fields("response", _RESPONSE), _fields("collected_at", TIME)
)

# What of an envelope says which result page it holds: parsing all the other fields costs as much again.
_PAGE_RESULT = _struct(_fields("items", T.ArrayType(_struct(_fields("type domain", STRING)))))
_PAGE_TASK = _struct(_fields("status_code", INT), _fields("result", T.ArrayType(_PAGE_RESULT)))
SERP_ENVELOPE = _struct(
    _fields("endpoint", STRING), _fields("request", T.ArrayType(_struct(_fields("keyword", STRING)))),
    _fields("response", _struct(_fields("status_code", INT), _fields("tasks", T.ArrayType(_PAGE_TASK)))), _fields("collected_at", TIME),
)

# What of an envelope says what was asked and when.
CALL_ENVELOPE = T.StructType([f for f in ENVELOPE.fields if f.name != "response"])

# The export's columns in order.
EXPORT_COLUMNS = (
    "keyword",
    "language_code",
    "location_code",
    "search_volume",
    "trend_3m",
    "trend_12m",
    "competition",
    "cpc",
    "source_terms",
    "source_urls",
    "intent_label",
    "cluster_label",
    "relevance_score",
    "opportunity_score",
    "recommended_action",
)

_EXPORT_TYPES = {"language_code": STRING, "location_code": INT} | {
    name: DOUBLE
    for name in ("search_volume", "trend_3m", "trend_12m", "competition", "cpc", "relevance_score", "opportunity_score")
}
EXPORT = _struct(*[_fields(name, _EXPORT_TYPES.get(name, STRING)) for name in EXPORT_COLUMNS])


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns in order, cast; absent ones as NULL."""
    present = set(df.columns)

    def pick(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[pick(f) for f in schema.fields])


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
