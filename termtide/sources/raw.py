"""The append-only log of raw responses: one JSON object per line, foldered by log and day."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import KNOWN_LOGS
from ..schemas import ENVELOPE, empty
from ..session import freed_shuffles

# an envelope with the folders that it lies in
LOGGED = T.StructType(ENVELOPE.fields + [T.StructField("log", T.StringType()), T.StructField("dt", T.StringType())])
# lines repeat all their names: compressed, a log takes a tenth or less; files have the size of a rebalanced partition
CODEC = "gzip"
# what lies beside the folders of logs: older files, at any depth
_BESIDE = "{[^l_.]*,l,l[^o]*,lo,lo[^g]*,log,log[^=]*}"


def stamped(raw: DataFrame, file: str = "_metadata.file_path") -> DataFrame:
    """Envelopes read from files, with the day of the file's name or folder where a line has no time."""
    day = F.regexp_extract(F.col(file), r"(?:^|[^0-9])((?:19|20)[0-9]{2}-?[01][0-9]-?[0-3][0-9])(?![0-9])", 1)
    time = F.coalesce("collected_at", F.try_to_timestamp(F.replace(day, F.lit("-"), F.lit("")), F.lit("yyyyMMdd")))
    return raw.withColumn("collected_at", time)


def _named(raw: DataFrame) -> DataFrame:
    """Envelopes of older files, under the folders in which they would be written now."""
    return raw.withColumns({"log": log_name("endpoint"), "dt": day_stamp("collected_at")})


def _folders(path: str, logs: Sequence[str], days: Sequence[str]) -> str:
    def one(name: str, values: Sequence[str]) -> str:
        return f"{name}={{{','.join(values)}}}" if values else f"{name}=*"

    return f"{path}/{one('log', logs)}/{one('dt', days)}"


def _loaded(reader, path: str, shape: T.StructType, line: bool, foldered: bool = False) -> DataFrame:
    """Envelopes of a path, parsed by the reader, or here if the lines themselves are wanted, too."""
    folders = LOGGED.fields[-2:] if foldered else []
    if not line:
        return stamped(reader.schema(T.StructType(shape.fields + folders)).json(path))
    text = reader.schema(T.StructType([T.StructField("value", T.StringType()), *folders])).text(path)
    named = [F.col("value").alias("line"), *[f.name for f in folders], F.col("_metadata.file_path").alias("_file")]
    return stamped(text.select(*named, _parsed("value", shape)), "_file").drop("_file")


def read_raw(
    spark: SparkSession, path: str, logs: Sequence[str] = (), days: Sequence[str] = (), shape: T.StructType = ENVELOPE, line: bool = False
) -> DataFrame:
    """All logged envelopes under a path with their ``log`` and day (``dt``), or those of some; blank lines drop out.

    Both are partition columns: a filter on them is a filter on folders, and given logs or
    days only their folders are listed. Older files beside the folders are read as well,
    their log and day come from the lines. A missing path is empty. A ``shape`` with only the
    fields that the caller needs saves making the others; it has endpoint and time. On request
    the text of each line comes along as ``line``, with all that the shape leaves out.
    """
    logged = T.StructType(shape.fields + LOGGED.fields[-2:] + [T.StructField("line", T.StringType())] * line)
    foldered = _found(spark.read.option("basePath", path), _folders(path, logs, days), shape, line, True)
    beside = _found(spark.read.option("recursiveFileLookup", "true"), f"{path}/{_BESIDE}", shape, line)
    if foldered is None and beside is None:
        # the path of a single file, or nothing
        beside = _found(spark.read.option("pathGlobFilter", "[^_.]*"), path, shape, line)
    if beside is not None:
        beside = _named(beside)
        for column, values in (("log", logs), ("dt", days)):
            beside = beside.where(F.col(column).isin(*values)) if values else beside
    parts = [p for p in (foldered, beside) if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else empty(spark, logged)


def _found(reader, *how) -> DataFrame | None:
    try:
        return _loaded(reader, *how)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stream_raw(
    spark: SparkSession, path: str, files_per_batch: int | None = None, logs: Sequence[str] = (), days: Sequence[str] = (),
    shape: T.StructType = ENVELOPE, line: bool = False,
) -> DataFrame:
    """``read_raw`` as a stream: a run takes the files that earlier runs have not, also of folders that are new."""

    def reader():
        return spark.readStream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else spark.readStream

    foldered = _loaded(reader().option("basePath", path), _folders(path, logs, days), shape, line, True)
    beside = _named(_loaded(reader().option("recursiveFileLookup", "true"), f"{path}/{_BESIDE}", shape, line))
    for column, values in (("log", logs), ("dt", days)):
        beside = beside.where(F.col(column).isin(*values)) if values else beside
    return foldered.unionByName(beside)


def parse_raw(lines: DataFrame, column: str = "value") -> DataFrame:
    """Envelopes from a column of JSON lines; inlined so that a line is parsed once, not per field.

    Blank lines are left out inside the expression: as a filter the planner would move the
    test below the column's making and make every line twice.
    """
    return lines.select(_parsed(column, ENVELOPE))


def _parsed(column: str, shape: T.StructType) -> Column:
    return F.inline(F.when(F.trim(F.col(column)) != "", F.array(F.from_json(column, shape))))


def log_name(endpoint: Column | str) -> Column:
    """Log a call belongs to: the known one in its path, else the path's last segment that is not the mode."""
    col = F.col(endpoint) if isinstance(endpoint, str) else endpoint
    name = F.when(F.lit(False), "")
    for known in KNOWN_LOGS:
        name = name.when(col.contains(known), known)
    return name.otherwise(F.regexp_extract(col, r"([A-Za-z0-9_]+)(?:/(?:live|advanced|explore))*/?$", 1))


def log_of(raw: DataFrame) -> Column:
    """The log of each envelope: its folder where it was read from one, so that filters prune, else by its endpoint."""
    return F.col("log") if "log" in raw.columns else log_name("endpoint")


def day_stamp(time: str) -> Column:
    return F.date_format(time, "yyyyMMdd")


def logged_lines(raw: DataFrame) -> DataFrame:
    """Envelopes as the lines (``value``) that a log has, with the log and day of their folder and their time."""
    fields = [c for c in raw.columns if c not in ("log", "dt")]
    line = F.to_json(F.struct(*fields))
    return raw.select(line.alias("value"), log_name("endpoint").alias("log"), day_stamp("collected_at").alias("dt"), "collected_at")


def append_lines(lines: DataFrame, path: str) -> None:
    """Append ``logged_lines``, foldered by log name and date stamp.

    Rebalancing gathers small folders into few files and splits a folder that
    most rows go to over several tasks. It moves lines, which are a fraction of parsed
    envelopes, and its files go once they are written. Sorted lines pack more tightly.
    """
    balanced = lines.select("value", "log", "dt").hint("rebalance", "log", "dt").sortWithinPartitions("log", "dt", "value")
    with freed_shuffles(lines.sparkSession):
        balanced.write.mode("append").partitionBy("log", "dt").text(path, compression=CODEC)


def append_raw(raw: DataFrame, path: str) -> None:
    """Append envelopes to a log, as lines in folders by log name and date stamp."""
    append_lines(logged_lines(raw), path)
