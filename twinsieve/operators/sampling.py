"""Reproducible sampling, shuffling and splitting by content hash.

Every draw depends only on the row key and the seed, never on partitioning. Exact quotas come from the
hash value at the wanted rank (``draw_cuts``), so the rows themselves are filtered in place and not
shuffled; a class may hold any share of the table.
"""

from __future__ import annotations

import logging
import secrets
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import c, draw_text, draw_uniform, ratio
from ..functions.ordered import draw_cuts, draw_rank, draw_struct
from ..functions.skew import attach_small

log = logging.getLogger(__name__)

# Default composition of a sample.
BENIGN_QUOTA = 200_000
ATTACK_TOTAL = (4_000, 6_200)
SEED = 42


class QuotaError(ValueError):
    """A source holds fewer rows than its quota."""


def resolve_seed(seed: int | None) -> int:
    """The given seed, or a fresh one that is logged so the run can be repeated."""
    if seed is not None:
        return seed
    fresh = secrets.randbelow(2**31)
    log.warning("no seed given; drew seed %d", fresh)
    return fresh


def sample_fraction(df: DataFrame, key: Sequence[str], target: int, seed: int | None = SEED,
                    total: int | None = None) -> DataFrame:
    """About ``target`` rows: each row is kept with probability target / total. No shuffle."""
    size = F.lit(total).cast("double") if total else df.agg(F.count(F.lit(1)).cast("double")).scalar()
    share = F.try_divide(F.lit(float(target)), size)
    return df.filter(draw_uniform([c(k) for k in key], resolve_seed(seed)) < share)


def draw_composition(attacks: Sequence[str], seed: int | None = SEED, benign: str = "Benign",
                     benign_quota: int = BENIGN_QUOTA, attack_total: tuple[int, int] = ATTACK_TOTAL,
                     concentration: float | None = 50.0) -> dict[str, int]:
    """Quota per class: a random attack total, split nearly evenly (Dirichlet), or evenly when
    ``concentration`` is None. A handful of scalars, drawn on the driver."""
    rng = np.random.default_rng(resolve_seed(seed))
    total = int(rng.integers(*attack_total))
    if concentration is None:
        shares = {name: total // len(attacks) for name in attacks}
    else:
        weights = rng.dirichlet(np.full(len(attacks), concentration))
        shares = {name: int(round(float(w) * total)) for name, w in zip(attacks, weights)}
    return {benign: benign_quota, **shares}


def even_quota(total: int, classes: Sequence[str]) -> dict[str, int]:
    return {name: total // len(classes) for name in classes}


def quota_table(df: DataFrame, cls: str, quotas: Mapping[str, int]) -> DataFrame:
    """(class, wanted, available, deficit): what each class asks for and what the table holds."""
    asked = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    counted = df.groupBy(c(cls)).agg(F.count(F.lit(1)).alias("available"))
    wanted = F.coalesce(asked[c(cls)], F.lit(0)).cast("bigint")
    present = counted.select(c(cls), wanted.alias("wanted"), "available")
    missing = df.sparkSession.createDataFrame([(k, int(v)) for k, v in quotas.items()], "cls string, n bigint") \
        .join(present.select(c(cls).alias("cls")), "cls", "left_anti") \
        .select(c("cls").alias(cls), c("n").alias("wanted"), F.lit(0).cast("bigint").alias("available"))
    return present.unionByName(missing).withColumn(
        "deficit", F.greatest(c("wanted") - c("available"), F.lit(0)))


def sample_quota(df: DataFrame, key: Sequence[str], cls: str, quotas: Mapping[str, int],
                 seed: int | None = SEED, take_all: bool = False) -> DataFrame:
    """Exactly ``quotas[class]`` rows of every named class.

    A class with fewer rows is an error, or is taken whole when ``take_all`` is set.
    """
    chosen = resolve_seed(seed)
    if not take_all:
        short = quota_table(df, cls, quotas).filter(c("deficit") > 0).limit(len(quotas)).collect()
        if short:
            raise QuotaError("too few rows: " + ", ".join(
                f"{r[cls]} has {r['available']} of {r['wanted']}" for r in sorted(short, key=lambda r: str(r[cls]))))
    named = df.filter(c(cls).isin(list(quotas)))
    asked = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    cuts = draw_cuts(named, key, chosen, cls, {"quota": F.least(asked[c(cls)], c("group_size"))})
    return _up_to(named, cuts.select(c(cls), c("cut")), key, cls, chosen)


def sample_stratified(df: DataFrame, key: Sequence[str], cls: str, quotas: Mapping[str, int],
                      seed: int | None = SEED) -> DataFrame:
    """Quota sample that takes a whole class when it is smaller than its quota."""
    return sample_quota(df, key, cls, quotas, seed, take_all=True)


def _up_to(df: DataFrame, cuts: DataFrame, key: Sequence[str], cls: str, seed: int) -> DataFrame:
    joined = attach_small(df, cuts, cls, key)
    mine = draw_struct(key, draw_text([c(k) for k in key], seed))
    return joined.filter(mine <= c("cut")).select(*[c(n) for n in df.columns])


def shuffle_order(df: DataFrame, key: Sequence[str], seed: int | None = SEED,
                  out: str = "position") -> DataFrame:
    """Add each row's 1-based position in a random order. Physical order is no contract in Spark."""
    return draw_rank(df, key, resolve_seed(seed), out=out)


# ---------------------------------------------------------------- splits

def split_stratified(df: DataFrame, key: Sequence[str], cls: str, test: float = 0.30,
                     validation: float = 0.20, seed: int | None = SEED, out: str = "split") -> DataFrame:
    """Label rows train / val / test with exact shares per class.

    ``test`` of the class, then ``validation`` of what is left. Each row is compared with two hash cuts
    of its class, so nothing but the cuts is shuffled. Rows without a class stay in ``train``.
    """
    chosen = resolve_seed(seed)
    tests = F.round(c("group_size") * F.lit(test)).cast("bigint")
    vals = F.round((c("group_size") - tests) * F.lit(validation)).cast("bigint")
    return _by_cuts(df, key, cls, chosen, {"test": tests, "val": tests + vals}, "train", out)


def split_bernoulli(df: DataFrame, key: Sequence[str], test: float = 0.30, validation: float = 0.20,
                    seed: int | None = SEED, out: str = "split") -> DataFrame:
    """Approximate split by hash ranges: one projection, for tables where exact shares do not matter."""
    u = draw_uniform([c(k) for k in key], resolve_seed(seed))
    rest = test + (1.0 - test) * validation
    return df.withColumn(out, F.when(u < F.lit(test), "test").when(u < F.lit(rest), "val").otherwise("train"))


def kfold_assign(df: DataFrame, key: Sequence[str], cls: str, folds: int = 5, seed: int | None = SEED,
                 out: str = "fold") -> DataFrame:
    """Stratified fold number 0..folds-1; fold sizes within a class differ by at most one.

    Rows without a class fall into the last fold.
    """
    size, extra = F.floor(c("group_size") / folds), c("group_size") % folds
    ends = {str(i): size * (i + 1) + F.least(extra, F.lit(i + 1)) for i in range(folds - 1)}
    cut = _by_cuts(df, key, cls, resolve_seed(seed), ends, str(folds - 1), out)
    return cut.withColumn(out, c(out).cast("int"))


def _by_cuts(df: DataFrame, key: Sequence[str], cls: str, seed: int, ranks: Mapping[str, Column],
             otherwise: str, out: str) -> DataFrame:
    """Name of the first part whose hash cut the row does not exceed."""
    cuts = draw_cuts(df, key, seed, cls, ranks)
    wide = cuts.groupBy(c(cls)).agg(*[F.max(F.when(c("part") == name, c("cut"))).alias(f"__{name}")
                                      for name in ranks])
    joined = attach_small(df, wide, cls, key, "left")
    mine = draw_struct(key, draw_text([c(k) for k in key], seed))
    label = F.lit(otherwise)
    for name in reversed(list(ranks)):
        label = F.when(mine <= c(f"__{name}"), F.lit(name)).otherwise(label)
    return joined.select(*[c(n) for n in df.columns], label.alias(out))


# ---------------------------------------------------------------- keys and weights

def with_occurrence(df: DataFrame, out: str = "occurrence") -> DataFrame:
    """Number equal rows 1, 2, 3, … so that (all columns, occurrence) is a key.

    Copies are counted per slice of the table and the slices' counts are stacked, so many copies of one
    row never meet in one task. Copies are equal, so it does not matter which slice comes first: the
    resulting rows are the same for every partitioning.
    """
    keys = [c(n) for n in df.columns]
    counts = (df.withColumn("__slice", F.spark_partition_id())
              .groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n")))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    shifted = counts.select(*keys, "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return shifted.select(
        *keys, F.explode(F.sequence(c("__before") + 1, c("__before") + c("__n"))).alias(out))


def class_weights(df: DataFrame, y: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (classes * rows of the class)."""
    counted = df.groupBy(c(y)).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy()      # over one row per class
    rows, kinds = F.sum("n").over(classes), F.count(F.lit(1)).over(classes)
    return counted.withColumn("weight", ratio(rows, kinds * c("n")))


def with_class_weight(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """Add the balanced weight of each row's 0/1 label; two scalars, no join."""
    totals = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(c(y).cast("bigint")).alias("pos"))).scalar()
    mine = F.when(c(y) == 1, totals["pos"]).otherwise(totals["n"] - totals["pos"])
    return df.withColumn(out, ratio(totals["n"], 2 * mine))
