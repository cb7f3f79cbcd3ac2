"""Stage tables as Parquet, entity exports and report files as CSV."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import MARKETS
from ..schemas import ENTITIES, EXPORT, ensure_columns
from .quoted_csv import read_csv

MARKET_COLUMNS = ("location_code", "language_code")
# compressed Parquet that one part of a dealt out table comes from
PART_BYTES = 8 << 20


def write_table(df: DataFrame, path: str, by_market: bool = False) -> None:
    """Replace a stage table; by market only the markets present are replaced."""
    if not by_market:
        df.write.mode("overwrite").parquet(path)
        return
    balanced = df.hint("rebalance", *MARKET_COLUMNS)
    writer = balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*MARKET_COLUMNS).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # partition columns come back last: select restores the contract's order
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def spread_few_files(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer files than cores, dealt out to all cores.

    A file may be one unsplittable piece, and text work on it would keep one core
    busy. The number of parts follows the size of the files, so that what a task holds
    does not. Tables of many files, which large ones are, stay as they are.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if len(files) >= cores:
        return df
    return df.repartition(max(cores, -(-_total_bytes(spark, files) // PART_BYTES)))


def spread_by_size(df: DataFrame, part_bytes: int) -> DataFrame:
    """Rows of a table, of however many files, dealt out by size: for work that makes many rows of one."""
    return df.repartition(parts_by_size(df, part_bytes))


def parts_by_size(df: DataFrame, part_bytes: int) -> int:
    """Number of parts of some size that a table's files come to; at least one for each core."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, -(-_total_bytes(spark, df.inputFiles()) // part_bytes))


def _total_bytes(spark: SparkSession, files: list[str]) -> int:
    """Size of some files, from their listing alone."""
    if not files:
        return 0
    return spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0


def read_optional_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return read_table(spark, path, schema)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_entities(spark: SparkSession, path: str, lone_quotes: bool = False) -> DataFrame:
    """Entity export with a header row; quoted fields may span lines.

    Large files are read by many tasks. With ``lone_quotes``, quotes may also stand in
    unquoted fields; each file is then read by one task, as its record ends depend on
    everything before them.
    """
    if not lone_quotes:
        return read_csv(spark, path, ENTITIES)
    reader = spark.read.schema(ENTITIES).option("header", True).option("multiLine", True)
    return reader.option("quote", '"').option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that ``read_entities`` reads back, quotes doubled; '' and null are the same there."""
    writer = df.write.mode("overwrite").option("header", True)
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**options).csv(path)


def export_opportunities(df: DataFrame) -> DataFrame:
    """The report export: exactly its columns, in order, absent ones as NULL."""
    return ensure_columns(df, EXPORT)


def export_clusters(summary: DataFrame, path: str) -> None:
    write_csv(summary, path)


def markets_df(spark: SparkSession) -> DataFrame:
    """The market dimension; its size is fixed by the configuration."""
    rows = [(m.key, m.name, m.location_code, m.language_code) for m in MARKETS]
    return spark.createDataFrame(rows, "key string, name string, location_code int, language_code string")


def lookup_market(df: DataFrame, key_column: str) -> DataFrame:
    """Add name, location and language of each row's market key; NULL when unknown."""
    markets = markets_df(df.sparkSession).withColumnRenamed("key", key_column)
    return df.join(F.broadcast(markets), key_column, "left")


def date_bucket(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def date_stamp(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyyMMdd")
