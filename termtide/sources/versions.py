"""Stage tables in versions: a stage may rewrite the table that it reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how to name a path in it: any that Spark reads, on whatever machine it is."""
    sc = spark.sparkContext
    to_path = sc._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(sc._jsc.hadoopConfiguration()), to_path


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder name of the version that readers see; None before the first."""
    fs, to_path = _files(spark, path)
    pointer = to_path(path, POINTER)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version of {path} has been written")
    return spark.read.parquet(f"{path}/{version}")


def write_version(df: DataFrame, path: str, keep: int = 0) -> str:
    """Write a new version, switch to it once it is whole, and delete all but ``keep`` of the older ones.

    ``df`` may read the current version. A run that fails leaves the current version as it
    was; the next one deletes what the failed one has left. One writer at a time.
    """
    spark = df.sparkSession
    before = current_version(spark, path)
    number = int(before.split("-")[0][1:]) + 1 if before else 1
    version = f"v{number:09d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs, to_path = _files(spark, path)
    fresh = to_path(path, f"_{version}")
    stream = fs.create(fresh, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    pointer = to_path(path, POINTER)
    # readers find the old pointer or, for the moment of a rename, none; never half a name
    if fs.exists(pointer):
        fs.delete(pointer, False)
    fs.rename(fresh, pointer)
    found = sorted(s.getPath().getName() for s in fs.listStatus(to_path(path)))
    whole = [v for v in found if v.startswith("v") and v != version and fs.exists(to_path(f"{path}/{v}", "_SUCCESS")) and v <= (before or "")]
    for old in found:
        if old.startswith(("v", "_v")) and old != version and old not in whole[len(whole) - keep :]:
            fs.delete(to_path(path, old), True)
    return version
