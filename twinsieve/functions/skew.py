"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import shuffle_width
from .columns import c

SUPPORT = 1e-3              # a key above this share of the rows counts as hot: at most 1 / SUPPORT keys
MAX_CLASS_ROWS = 10_000     # per-class tables that may travel through the driver
MAX_KEY_ROWS = 100_000      # narrow key tables that may be broadcast


def hot_keys(df: DataFrame, key: str, support: float = SUPPORT) -> list:
    """Every key that holds more than ``support`` of the rows (and perhaps a few others).

    One pass with bounded state; at most ``1 / support`` keys come back.
    """
    found = df.filter(c(key).isNotNull()).select(c(key).alias("k")).stat.freqItems(["k"], support)
    return [k for k in found.first()[0] or [] if k is not None]


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str, salt_on: Sequence[str],
                support: float = SUPPORT, hot: list | None = None) -> DataFrame:
    """Equi-join ``left`` with ``right``, where ``right`` has one row per key.

    Left rows of a hot key get a salt from ``salt_on`` (columns that tell its rows apart) and the one
    right row of that key is repeated once per salt. Left rows without a key match nothing and are
    spread the same way. ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = hot_keys(left, key, support) if hot is None else hot
    if not keys and how in ("inner", "left_semi"):
        return left.join(right, key, how)
    salts = min(1024, max(2, shuffle_width(left.sparkSession)))
    is_hot = c(key).isin(keys) if keys else F.lit(False)
    # The input split is part of the salt, so copies of one row spread too; a retried task salts alike.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[c(s) for s in salt_on]), F.lit(salts)).cast("int")
    salted = left.withColumn("__salt", F.when(is_hot | c(key).isNull(), spread).otherwise(F.lit(0)))
    copies = right.withColumn(
        "__salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1)))
                            .otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [key, "__salt"], how).drop("__salt")


def even_join(left: DataFrame, right: DataFrame, key: str, how: str, salt_on: Sequence[str],
              max_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """Join rows with a table of one narrow row per key.

    ``right`` should be a scan or a checkpoint: its first ``max_rows + 1`` rows are counted. If it is that
    small it is broadcast and ``left`` is not shuffled at all; otherwise hot keys are salted.
    """
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, how, salt_on)


def small_side(df: DataFrame, max_rows: int = MAX_CLASS_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast copy of a per-class table after checking that it is small; computed only once.

    At most ``max_rows + 1`` rows reach the driver. A larger table comes back as it was, marked False.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df, False
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), True


def attach_small(left: DataFrame, right: DataFrame, key: str, salt_on: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join a per-class table onto rows: broadcast when its size is proven, salted join beyond that."""
    side, fits = small_side(right)
    if fits:
        return left.join(side, key, how)
    return salted_join(left, side, key, how, salt_on)
