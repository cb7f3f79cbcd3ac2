"""CSV with line breaks inside quoted fields, read by many tasks per file.

A line break ends a record when the number of quotes before it is even. Lines are read in
splits; each split sums up its quotes and, for either parity it may begin with, its last
record start. One row per split and a running sum over a file's splits then tell every
split how it begins, and its lines find their records by themselves. Records of one line,
nearly all, are whole where they stand; only the lines of the others are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

SPLIT = ("_file", "_begin")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split, their place there and the quotes of the split up to and with them."""
    read = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_begin"),
        F.monotonically_increasing_id().alias("_id"),
    )
    own = read.withColumn("_quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    so_far = Window.partitionBy(*SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return own.withColumn("_sum", F.sum("_quotes").over(so_far))


def _begins(parity: Column) -> Column:
    """Whether a line begins a record, if its split begins with this parity of quotes."""
    return (F.col("_sum") - F.col("_quotes") + parity) % 2 == 0


def _splits(lines: DataFrame) -> DataFrame:
    """Of each split: the parity it begins with and the start of the record it begins in."""
    ends = lines.groupBy(*SPLIT).agg(
        F.sum("_quotes").alias("_n"),
        *[F.max(F.when(_begins(F.lit(p)), F.struct("_begin", "_id"))).alias(f"_last{p}") for p in (0, 1)],
    )
    # one row per split of a file
    before = Window.partitionBy("_file").orderBy("_begin").rowsBetween(Window.unboundedPreceding, -1)
    known = ends.withColumn("_parity", F.coalesce(F.sum("_n").over(before), F.lit(0)) % 2)
    last = F.when(F.col("_parity") == 0, F.col("_last0")).otherwise(F.col("_last1"))
    return known.withColumn("_last", last).select(
        *SPLIT, "_parity", F.last("_last", ignorenulls=True).over(before).alias("_open")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as text, ``record``, without the first one of each file; empty ones are left out."""
    lines = _lines(spark, path)
    placed = lines.join(_splits(lines), [*SPLIT]).withColumn("_new", _begins(F.col("_parity")))
    here = F.struct("_begin", "_id")
    heads = F.col("_new") & (F.col("_quotes") % 2 == 0)
    single = placed.where(heads).select("_file", here.alias("_at"), F.col("value").alias("record"))
    up_to = Window.partitionBy(*SPLIT).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.coalesce(F.last(F.when(F.col("_new"), here), ignorenulls=True).over(up_to), F.col("_open"))
    parts = placed.withColumn("_at", owner).where(~heads).groupBy("_file", "_at").agg(
        F.sort_array(F.collect_list(F.struct("_begin", "_id", "value"))).alias("_parts")
    )
    joined = parts.select("_file", "_at", F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("record"))
    records = single.unionByName(joined)
    first = lines.where("_begin = 0").groupBy("_file").agg(F.min(F.struct(here.alias("at"), F.col("value").endswith("\r").alias("crlf"))).alias("_first"))
    # one row per file, which every file with a line has
    kept = records.join(first, "_file").where(F.col("_at") != F.col("_first.at"))
    text = F.when(F.col("_first.crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    return kept.select(F.regexp_replace(text, r"\r\z", "").alias("record")).where("record <> ''")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of files with a header record, quotes doubled inside quoted fields.

    A quote stands only in quoted fields, as the usual writers have it. Records end with
    LF or CR LF; in files whose first line ends with CR LF, fields have it as LF. An unquoted empty field is null, short records end in nulls, further
    fields are left out, empty lines are no records, an open quote runs to the end of
    its file, less its last line break. Files without a record after the header give no rows.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    rows = read_records(spark, path).select(F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("_row"))
    return rows.select("_row.*")
