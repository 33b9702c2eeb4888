"""Labelled scans, source checks and path routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import c

# Which files belong to the study, by lower-cased path.
INCLUDE_PATTERNS = [
    r"benign",
    r"ddos.*http.*flood",
    r"(?<!d)dos.*http.*flood",
    r"dns.*spoof",
    r"xss",
    r"brute.*force",
    r"readme",
]
EXCLUDE_PATTERNS = [
    r"tcp.*flood",
    r"udp",
]


class MissingSourceError(FileNotFoundError):
    """An expected input is absent."""


# ---------------------------------------------------------------- scans

def scan_labelled(spark: SparkSession, sources: Mapping[str, Sequence[str]], label: str = "Label",
                  schema: T.StructType | str | None = None, fmt: str = "csv",
                  source_column: str | None = None, **options: object) -> DataFrame:
    """Read every class's files and add the class as a column; columns missing in a file become null.

    Give a schema for large inputs: without one, CSV columns are read as text.
    """
    parts = []
    for name, paths in sources.items():
        reader = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {}), **options)
        if schema is not None:
            reader = reader.schema(schema)
        frame = reader.load(list(paths))
        if source_column:
            frame = frame.select("*", F.col("_metadata.file_path").alias(source_column))
        parts.append(frame.withColumn(label, F.lit(name)))
    return union_labelled(parts)


def union_labelled(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_named(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None,
               fmt: str = "csv", **options: object) -> DataFrame:
    """Read every file called ``name`` (a glob) anywhere below ``root``."""
    reader = (spark.read.format(fmt).option("recursiveFileLookup", True).option("pathGlobFilter", name)
              .options(**({"header": True} if fmt == "csv" else {}), **options))
    return (reader.schema(schema) if schema is not None else reader).load(root)


def find_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, length) of the files called ``name`` below ``root``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", name).load(root).select("path", "length"))


def label_by_path(df: DataFrame, patterns: Mapping[str, str], path: Column | None = None,
                  label: str = "Label") -> DataFrame:
    """Class of each row from the file it came from: the first pattern that matches its path."""
    where = F.col("_metadata.file_path") if path is None else path
    out = F.lit(None).cast("string")
    for name, pattern in reversed(list(patterns.items())):
        out = F.when(where.rlike(pattern), F.lit(name)).otherwise(out)
    return df.withColumn(label, out)


# ---------------------------------------------------------------- checks

def source_counts(df: DataFrame, source: str) -> DataFrame:
    """Records per source. Counts records, so line breaks inside quotes are counted right."""
    return df.groupBy(c(source)).agg(F.count(F.lit(1)).alias("n"))


def missing_sources(expected: DataFrame, df: DataFrame, source: str) -> DataFrame:
    """Expected sources of which no record was seen."""
    seen = df.select(c(source)).distinct()
    return expected.join(seen, source, "left_anti")


def require_sources(expected: Sequence[str], df: DataFrame, source: str) -> None:
    """Raise when an expected source is absent. The list is the caller's, so it is short."""
    wanted = df.sparkSession.createDataFrame([(n,) for n in expected], f"`{source}` string")
    absent = sorted(r[0] for r in missing_sources(wanted, df, source).collect())
    if absent:
        raise MissingSourceError(f"missing sources: {absent}")


# ---------------------------------------------------------------- paths

def wanted_path(path: Column, include: Sequence[str] = tuple(INCLUDE_PATTERNS),
                exclude: Sequence[str] = tuple(EXCLUDE_PATTERNS)) -> Column:
    """Keep a path that matches an include pattern and no exclude pattern."""
    low = F.lower(path)
    hit = low.rlike("|".join(f"(?:{p})" for p in include))
    return hit & ~low.rlike("|".join(f"(?:{p})" for p in exclude)) if exclude else hit


def route_path(path: Column, flow_word: str = "flow based") -> Column:
    """Struct (layer, category, file_name) of a relative path.

    The first folder tells the layer, the last folder the category (``root`` when there is none), with
    characters that folder names cannot hold replaced by ``_``.
    """
    plain = F.replace(F.coalesce(F.try_url_decode(path), path), F.lit("+"), F.lit(" "))
    parts = F.filter(F.split(plain, r"[/\\]"), lambda p: p != "")
    folder = F.when(F.size(parts) > 2, F.element_at(parts, -2)).otherwise(F.lit("root"))
    return F.struct(
        F.when(F.lower(F.element_at(parts, 1)).contains(flow_word), "flow").otherwise("packet").alias("layer"),
        F.regexp_replace(folder, r'[<>:"/\\|?*]', "_").alias("category"),
        F.element_at(parts, -1).alias("file_name"))
