"""Intermediate tables written once, as Parquet, in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


BATCH_BYTES = 4 << 20       # Arrow batches of whole texts; a longer text is a batch of its own
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_BYTES, unless it is lower already.

    Rows hold whole texts, and each running task keeps several batches outside the heap.
    """
    held = spark.conf.get(_BATCH, None)
    if held is not None and not 0 < int(held.rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: compressed, pruned by column, safe from lost executors."""
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


class Tables:
    """Intermediate tables of one operator, deleted when their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        held, path = _written(df, name)
        self.paths[id(held)] = held, path
        return held

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of tables that were stored here; others are left alone."""
        for table in tables:
            _, path = self.paths.pop(id(table), (None, ""))
            if path:
                where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def drop_all(self) -> None:
        self.drop(*[table for table, _ in list(self.paths.values())])
