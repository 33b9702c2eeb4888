"""Confusion counts, metric blocks, two-stage combination and paired comparison.

Rows are reduced once to counts per (label, verdicts); every metric is arithmetic on those few counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c, ratio

ALPHA = 0.05


# ---------------------------------------------------------------- counts and metric block

def confusion_cells(y: Column, pred: Column, weight: Column | None = None) -> list[Column]:
    """The four confusion counts as aggregates; ``weight`` rows stand for several."""
    w = F.lit(1).cast("bigint") if weight is None else weight
    return [F.coalesce(F.sum(F.when((y == truth) & (pred.cast("int") == verdict), w)), F.lit(0)).cast("bigint").alias(name)
            for truth, verdict, name in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One row with tn, fp, fn, tp."""
    return df.agg(*confusion_cells(c(y), c(pred)))


def metric_block(counts: DataFrame) -> DataFrame:
    """Add precision (0 when nothing was flagged), recall, f1, fpr, fnr, accuracy to tn, fp, fn, tp."""
    tn, fp, fn, tp = (c(n) for n in ("tn", "fp", "fn", "tp"))
    zero = F.lit(0.0)
    return counts.select(
        "*",
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
        ratio(fp, fp + tn).alias("fpr"), ratio(fn, fn + tp).alias("fnr"),
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"))


def evaluate(df: DataFrame, y: str, pred: str) -> DataFrame:
    return metric_block(confusion(df, y, pred))


def detection_by_class(df: DataFrame, cls: str, pred: str) -> DataFrame:
    """Row count and flagged share per class."""
    return df.groupBy(c(cls)).agg(F.count(F.lit(1)).alias("n"),
                                  F.avg(c(pred).cast("double")).alias("detection_rate"))


def long_metrics(blocks: DataFrame, system: str = "system") -> DataFrame:
    """(system, metric, value) rows of a metric table."""
    names = [n for n in blocks.columns if n != system]
    wide = blocks.select(c(system), *[c(n).cast("double").alias(n) for n in names])
    return wide.unpivot([system], names, "metric", "value")


# ---------------------------------------------------------------- two stages

def joint_counts(df: DataFrame, y: str, s1: str, s2: str) -> DataFrame:
    """Rows per (y, s1, s2): at most 12 cells, where s2 may be null for rows stage 2 never saw."""
    return df.groupBy(c(y).cast("int").alias("y"), c(s1).cast("int").alias("s1"),
                      c(s2).cast("int").alias("s2")).agg(F.count(F.lit(1)).alias("n"))


def two_stage_systems(cells: DataFrame) -> DataFrame:
    """Confusion counts of each stage alone, of the cascade (AND) and of the union (OR)."""
    s1, s2 = c("s1") == 1, F.coalesce(c("s2") == 1, F.lit(False))
    verdicts = F.array(
        _verdict("stage1", s1), _verdict("stage2", s2),
        _verdict("cascade_and", s1 & s2), _verdict("union_or", s1 | s2))
    expanded = cells.select("y", "n", F.inline(verdicts))
    return counts_by_system(expanded)


def _verdict(name: str, flag: Column) -> Column:
    return F.struct(F.lit(name).alias("system"), flag.cast("int").alias("pred"))


def counts_by_system(expanded: DataFrame) -> DataFrame:
    return expanded.groupBy("system").agg(*confusion_cells(c("y"), c("pred"), c("n")))


def cascade_union(df: DataFrame, y: str, s1: str, s2: str) -> DataFrame:
    return metric_block(two_stage_systems(joint_counts(df, y, s1, s2)))


def detection_cascade_union(df: DataFrame, cls: str, s1: str, s2: str) -> DataFrame:
    """Flagged share per class for the cascade and the union."""
    first, second = c(s1) == 1, F.coalesce(c(s2) == 1, F.lit(False))
    return df.groupBy(c(cls)).agg(
        F.count(F.lit(1)).alias("n"), F.avg((first & second).cast("double")).alias("cascade_and"),
        F.avg((first | second).cast("double")).alias("union_or"))


def with_final_verdict(df: DataFrame, s1: str, s2: str, out: str = "final") -> DataFrame:
    """Alert stays when stage 2 agrees or never saw it; everything else follows stage 1."""
    kept = (c(s1) == 1) & F.coalesce(c(s2) == 1, F.lit(True))
    return df.withColumn(out, kept.cast("int"))


def combined_confusion(df: DataFrame, y: str, s1: str, s2: str) -> DataFrame:
    """Metric block of the re-checked system and its share of stage-1 false positives removed."""
    cells = with_final_verdict(joint_counts(df, y, s1, s2), "s1", "s2")
    before = F.sum(F.when((c("y") == 0) & (c("s1") == 1), c("n")))
    counts = cells.agg(*confusion_cells(c("y"), c("final"), c("n")), before.alias("fp_before"))
    return metric_block(counts).withColumn("fp_reduction", 1 - ratio(c("fp"), c("fp_before"))).drop("fp_before")


def system_comparison(df: DataFrame, y: str, verdicts: Mapping[str, Column]) -> DataFrame:
    """Metric rows of several named verdict columns, from one pass over the rows."""
    flags = [flag.cast("int").alias(f"p{i}") for i, flag in enumerate(verdicts.values())]
    cells = df.select(c(y).cast("int").alias("y"), *flags).groupBy("y", *[f"p{i}" for i in range(len(flags))]) \
        .agg(F.count(F.lit(1)).alias("n"))
    systems = F.array(*[_verdict(name, c(f"p{i}") == 1) for i, name in enumerate(verdicts)])
    return metric_block(counts_by_system(cells.select("y", "n", F.inline(systems))))


def screening_load(df: DataFrame, y: str, s1: str, s2: str) -> DataFrame:
    """Share of rows that reach stage 2 and alert precision before and after it."""
    cells = with_final_verdict(joint_counts(df, y, s1, s2), "s1", "s2")

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, c("n"))), F.lit(0))

    flagged, kept, hit = c("s1") == 1, c("final") == 1, c("y") == 1
    return cells.agg(ratio(n(flagged), F.sum("n")).alias("screening_load"),
                     ratio(n(flagged & hit), n(flagged)).alias("precision_before"),
                     ratio(n(kept & hit), n(kept)).alias("precision_after"))


# ---------------------------------------------------------------- paired comparison

def mcnemar_counts(df: DataFrame, y: str, before: str, after: str) -> DataFrame:
    """Discordant rows: ``b`` wrong before and right after, ``c`` right before and wrong after."""
    was, now = c(before).cast("int") == c(y).cast("int"), c(after).cast("int") == c(y).cast("int")
    return df.agg(F.count_if(~was & now).alias("b"), F.count_if(was & ~now).alias("c"))


def binomial_two_sided(b: int, c_: int) -> float:
    """Exact two-sided binomial p-value at one half. Terms shrink fast, so the tail sum stops early."""
    n, k = b + c_, min(b, c_)
    if n == 0 or 2 * k == n:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) - n * math.log(2.0))
    total = 0.0
    while k >= 0 and term > total * 1e-17:
        total += term
        term *= k / (n - k + 1)
        k -= 1
    return min(1.0, 2.0 * total)


def verdict_text(b: int, c_: int, p: float, alpha: float = ALPHA) -> str:
    if b + c_ == 0:
        return "no discordant pairs"
    if p >= alpha:
        return f"not significant at alpha={alpha}"
    return "significant improvement" if b > c_ else "significantly worse"


def mcnemar(df: DataFrame, y: str, before: str, after: str, alpha: float = ALPHA) -> DataFrame:
    """Exact McNemar test. Spark counts the discordant rows; the tail is a scalar on two counts."""
    def test(batches):
        for pdf in batches:
            ps = [binomial_two_sided(int(b), int(k)) for b, k in zip(pdf["b"], pdf["c"])]
            yield pd.DataFrame({
                "b": pdf["b"], "c": pdf["c"], "p_value": ps, "significant": [p < alpha for p in ps],
                "verdict": [verdict_text(int(b), int(k), p, alpha)
                            for b, k, p in zip(pdf["b"], pdf["c"], ps)]})

    return mcnemar_counts(df, y, before, after).mapInPandas(
        test, "b bigint, c bigint, p_value double, significant boolean, verdict string")


def bootstrap_ci(df: DataFrame, y: str, s1: str, s2: str, replicates: int = 2000, seed: int = 42,
                 level: float = 0.95) -> DataFrame:
    """Interval of F1(cascade) - F1(stage 1) over resampled rows.

    A bootstrap of rows is a multinomial draw over the counts per (y, s1, final), so the rows are read
    once and each replicate costs eight draws.
    """
    cells = with_final_verdict(joint_counts(df, y, s1, s2), "s1", "s2").groupBy("y", "s1", "final").agg(
        F.sum("n").alias("n"))
    packed = cells.agg(F.array_sort(F.collect_list(F.struct("y", "s1", "final", "n"))).alias("cells"))
    repeated = packed.select("cells", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))

    def draw(batches):
        for pdf in batches:
            gains = []
            for packed_cells, replicate in zip(pdf["cells"], pdf["replicate"]):
                rows = [(r["y"], r["s1"], r["final"], r["n"]) for r in packed_cells]
                if not rows:            # nothing to draw from
                    gains.append(None)
                    continue
                n = np.array([r[3] for r in rows], dtype=np.int64)
                rng = np.random.default_rng([seed, int(replicate)])
                got = rng.multinomial(n.sum(), n / n.sum())
                gains.append(_f1_of(rows, got, 2) - _f1_of(rows, got, 1))
            yield pd.DataFrame({"gain": gains})

    gains = repeated.repartition("replicate").mapInPandas(draw, "gain double")
    tail = (1.0 - level) / 2.0
    observed = system_comparison(
        with_final_verdict(df, s1, s2), y, {"before": c(s1) == 1, "after": c("final") == 1})
    gain = observed.agg(F.max(F.when(c("system") == "after", c("f1")))
                        - F.max(F.when(c("system") == "before", c("f1")))).scalar()
    return gains.agg(F.percentile("gain", F.lit(tail)).alias("ci_low"),
                     F.percentile("gain", F.lit(1.0 - tail)).alias("ci_high"),
                     F.count("gain").alias("replicates")).withColumn("f1_gain", gain)


def _f1_of(rows: Sequence[tuple], counts: np.ndarray, verdict: int) -> float:
    tp = sum(int(k) for r, k in zip(rows, counts) if r[0] == 1 and r[verdict] == 1)
    wrong = sum(int(k) for r, k in zip(rows, counts) if r[0] != r[verdict])
    return 2 * tp / (2 * tp + wrong) if tp else 0.0
