"""Writers for tables, feature matrices, curves and metrics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..functions.columns import c
from ..operators.quality import feature_names

CURVE_POINTS = 1_000_000        # points of one part of a curve


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "errorifexists", **options: object) -> None:
    """Write a sample, bookkeeping or alert table, split into folders by split or class if asked."""
    if fmt == "csv":
        options = {"header": True, **options}
    writer = df.write.format(fmt).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_features(df: DataFrame, path: str, features: str = "features", keep: Sequence[str] = (),
                   mode: str = "errorifexists") -> None:
    """Write a feature matrix beside its bookkeeping columns. Names travel in the ML attributes."""
    if not feature_names(df, features):
        raise ValueError(f"column {features!r} carries no feature names")
    df.select(*[c(n) for n in keep], c(features)).write.mode(mode).parquet(path)


def write_metrics(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Write a metric table or sweep. It has a row per system or cut, so one file is enough; see ``write_curve``."""
    df.coalesce(1).write.format(fmt).mode(mode).save(path)


def write_curve(df: DataFrame, path: str, order: str = "threshold", points_per_part: int = CURVE_POINTS) -> None:
    """Write a curve with a point per distinct score in ascending order, by as many tasks as its length asks for.

    Each part holds one range of ``order`` and is sorted; the manifest beside the points names every part with its
    number of points and its first and last value. The manifest is written last: without it a curve is unfinished.
    """
    spark = df.sparkSession
    parts = max(1, -(-df.count() // points_per_part))
    placed = df.repartitionByRange(parts, c(order)).sortWithinPartitions(c(order)).withColumn("part", F.spark_partition_id())
    placed.write.partitionBy("part").parquet(f"{path}/points")
    written = spark.read.schema(placed.schema).parquet(f"{path}/points")
    manifest = written.groupBy("part").agg(F.count(F.lit(1)).alias("points"), F.min(c(order)).alias("first"), F.max(c(order)).alias("last"))
    manifest.coalesce(1).sortWithinPartitions("part").write.parquet(f"{path}/manifest")     # a row per part


def curve_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read_curve(spark: SparkSession, path: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Points of a curve, or of the parts that reach into a range of its order; ``part`` gives the order of parts.

    Parts outside the range are not read. Within a part the points are in order.
    """
    held = curve_manifest(spark, path)
    if low is not None:
        held = held.filter(c("last") >= F.lit(low))
    if high is not None:
        held = held.filter(c("first") <= F.lit(high))
    points = spark.read.parquet(f"{path}/points")
    return points if low is None and high is None else points.filter(c("part").isin([r["part"] for r in held.select("part").collect()]))


def curve_in_order(spark: SparkSession, path: str) -> Iterator[Row]:
    """All points in order, one part at a time in the driver, for a plot or a report."""
    names = sorted(r["part"] for r in curve_manifest(spark, path).select("part").toLocalIterator())
    points = spark.read.parquet(f"{path}/points")
    for part in names:
        yield from points.filter(c("part") == F.lit(part)).coalesce(1).drop("part").toLocalIterator()
