"""Cross-stage report: stage 1 alone, stage 2 alone, both together, and whether the gain is real."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c
from ..operators.evaluation import (ALPHA, counts_by_system, joint_counts, mcnemar, metric_block,
                                    with_final_verdict)

HEADLINE = ["precision", "recall", "f1", "accuracy"]


def stage_report(df: DataFrame, y: str, s1: str, s2: str) -> DataFrame:
    """(system, counts, headline metrics) of stage 1, stage 2 and the combined system.

    Stage 2 alone is judged on the rows it saw; the combined system keeps stage 1's verdict elsewhere.
    """
    cells = with_final_verdict(joint_counts(df, y, s1, s2), "s1", "s2")
    systems = F.array(_entry("stage1", c("s1")), _entry("stage2", c("s2")), _entry("combined", c("final")))
    long = cells.select("y", "n", F.inline(systems)).filter(c("pred").isNotNull())
    return metric_block(counts_by_system(long)).select("system", "tn", "fp", "fn", "tp", *HEADLINE)


def _entry(name: str, verdict):
    return F.struct(F.lit(name).alias("system"), verdict.alias("pred"))


def significance(df: DataFrame, y: str, s1: str, s2: str, alpha: float = ALPHA) -> DataFrame:
    """Exact McNemar test of the combined system against stage 1."""
    return mcnemar(with_final_verdict(df, s1, s2), y, s1, "final", alpha)
