"""Session settings and the shared folder for checkpoints and stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the operators count on. Partition counts stay with the cluster: AQE
# coalesces and splits at run time, so a large initial number costs little.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # expression building need not record the Python line of every call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a fresh local one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="termtide-"))
    return sc.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/termtide/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder once and read it back.

    Later uses read columns of the written table instead of computing it again,
    its true size is known to the join planner, and lost executors cost nothing.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs inside the block give back their shuffle files as they end, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


@contextmanager
def passing_stage(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A staged table for the block alone, packed tightly: its files go at the block's end, its job's shuffle files before."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    try:
        with freed_shuffles(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        sc = spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


class Buckets:
    """Written tables bucketed by a key: joins and groupings by it do not shuffle them again."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []
        self.count = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, label: str, key: str) -> tuple[DataFrame, DataFrame]:
        """Write ``df`` in as many buckets as there are shuffle partitions; rows of one key must be few.

        Gives the bucketed table, and the same rows by their files, which outlive the catalog's entry.
        """
        path = new_folder(self.spark, label)
        name = "termtide_" + path.rsplit("-", 1)[-1]
        self.names.append(name)
        writer = df.repartition(self.count, key).write.format("parquet").bucketBy(self.count, key)
        writer.option("path", path).saveAsTable(name)
        return self.spark.table(name), self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def buckets(spark: SparkSession) -> Iterator[Buckets]:
    """Bucketed tables known to the catalog inside the block; their files stay for the results that read them."""
    made = Buckets(spark)
    try:
        yield made
    finally:
        for name in made.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
