"""Session-level settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master may fall back to
    a temporary folder; anywhere else a missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="twinsieve-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there afterwards.

    Used for a model score that several later aggregations read, so the Python scoring runs once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """Parallelism the session asks for; bucket and salt counts follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than the session's parallelism over all cores.

    For Python-heavy scoring of a table that sits in a few files. A large table has more splits than
    cores and comes back as it is. Give a plan without shuffles, so that counting splits runs no job.
    """
    width = shuffle_width(df.sparkSession)
    return df.repartition(width) if df.rdd.getNumPartitions() < width else df


class SharedTables:
    """Results that several readers need: each is written once to the shared folder and deleted when the scope ends.

    Use it as a context manager, or call ``release`` when the last reader is done. A table handed out must not be
    read after that.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str = "shared") -> DataFrame:
        path = f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        for path in self.paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths.clear()

    def __enter__(self) -> SharedTables:
        return self

    def __exit__(self, *error: object) -> None:
        self.release()
