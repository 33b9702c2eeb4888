"""Exact threshold curves and operating-point choice.

Rows are first collapsed to one row per distinct score (map-side combine). Cumulative counts then come
from the bucketed prefix sum, and every grid sweep is one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c, cuts_passed, ratio
from ..functions.ordered import exact_quantiles, prefix_sums, with_value_bucket
from ..session import cut_lineage

EPSILON = 1e-12
RECALL_TARGET = 0.85
STAGE_ONE_RECALL = 0.90
RETENTION_FLOOR = 90.0
CONTAMINATION = 0.02


def recheck_grid() -> list[float]:
    """19 cuts from 0.05 to 0.95."""
    return [round(0.05 * i, 2) for i in range(1, 20)]


def quantile_grid(points: int = 25, first: float = 0.50, last: float = 0.999) -> list[float]:
    step = (last - first) / (points - 1)
    return [first + step * i for i in range(points - 1)] + [last]


# ---------------------------------------------------------------- curves over distinct scores

def score_histogram(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    valid = df.filter(c(score).isNotNull() & ~F.isnan(c(score)))
    return valid.groupBy(*[c(g) for g in group], c(score).alias("threshold")).agg(
        F.sum(c(y).cast("bigint")).alias("pos"), F.sum((1 - c(y)).cast("bigint")).alias("neg"))


def cumulative_counts(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """(threshold, tp, fp, pos, neg, all_pos, all_neg) at every distinct score, prediction score >= t."""
    # The rows are read once; edges, sums and order come from the stored histogram.
    hist = cut_lineage(score_histogram(df, y, score, group).withColumn("threshold", c("threshold").cast("double")))
    tagged = with_value_bucket(hist, "threshold")
    summed = prefix_sums(tagged, "__bucket", [c("threshold").desc()], ["pos", "neg"], group, descending=True)
    return summed.select(*[c(g) for g in group], "threshold", "pos", "neg",
                         c("pos_cum").alias("tp"), c("neg_cum").alias("fp"),
                         c("pos_all").alias("all_pos"), c("neg_all").alias("all_neg"))


def pr_curve(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score."""
    counts = cumulative_counts(df, y, score, group)
    return counts.select(*[c(g) for g in group], "threshold", "tp", "fp",
                         ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
                         ratio(c("tp"), c("all_pos")).alias("recall"))


def with_f1(curve: DataFrame) -> DataFrame:
    p, r = c("precision"), c("recall")
    return curve.withColumn("f1", 2 * p * r / (p + r + F.lit(EPSILON)))


def best_f1(curve: DataFrame) -> DataFrame:
    """Threshold with the highest F1; among equals the lowest."""
    ranked = with_f1(curve)
    return ranked.agg(F.max_by("threshold", F.struct(c("f1"), -c("threshold"))).alias("threshold"),
                      F.max("f1").alias("f1"))


def f1_threshold(df: DataFrame, y: str, score: str) -> DataFrame:
    return best_f1(pr_curve(df, y, score))


def recall_threshold(df: DataFrame, y: str, score: str, target: float = RECALL_TARGET) -> DataFrame:
    """Largest threshold that still reaches the recall target; the F1-best one if none does."""
    ranked = with_f1(pr_curve(df, y, score))
    reached = F.max(F.when(c("recall") >= F.lit(target), c("threshold")))
    balanced = F.max_by("threshold", F.struct(c("f1"), -c("threshold")))
    return ranked.agg(F.coalesce(reached, balanced).alias("threshold"),
                      reached.isNotNull().alias("target_met"))


def roc_curve(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    counts = cumulative_counts(df, y, score, group)
    return counts.select(*[c(g) for g in group], "threshold",
                         ratio(c("fp"), c("all_neg")).alias("fpr"),
                         ratio(c("tp"), c("all_pos")).alias("tpr"))


def roc_auc(df: DataFrame, y: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; tied scores count half. Null when one class is absent."""
    counts = cumulative_counts(df, y, score, group)
    area = F.sum(c("neg").cast("double") * (c("tp") - c("pos") + c("pos") * F.lit(0.5).cast("double")))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    keyed = counts.groupBy(*[c(g) for g in group]) if group else counts
    return keyed.agg(F.try_divide(area, pairs).alias("auc"))


# ---------------------------------------------------------------- quantile cuts

def contamination_cut(train: DataFrame, score: str, contamination: float = CONTAMINATION) -> float | None:
    """Score that the wanted share of the training rows exceeds."""
    return exact_quantiles(train, {"s": c(score)}, [1.0 - contamination])["s"][0]


def class_quantile_cut(df: DataFrame, y: str, score: str, recall: float = STAGE_ONE_RECALL) -> float | None:
    """Cut that keeps about ``recall`` of the attack rows; take it on validation rows."""
    return exact_quantiles(df.filter(c(y) == 1), {"s": c(score)}, [1.0 - recall])["s"][0]


def worst_trimmed(df: DataFrame, score: str, share: float = 0.10) -> tuple[DataFrame, float | None]:
    """Rows without the ``share`` of highest scores, and the cut used."""
    cut = exact_quantiles(df, {"s": c(score)}, [1.0 - share])["s"][0]
    return df.filter(c(score) <= F.lit(cut)), cut


# ---------------------------------------------------------------- sweeps

def _cut_value(index: Column, cuts: Sequence[float]) -> Column:
    return F.element_at(F.array(*[F.lit(float(t)) for t in cuts]), index)


def _reached(cells: Column, name: str, condition) -> Column:
    """Sum of one count over the cells that meet a condition."""
    return F.aggregate(F.filter(cells, condition), F.lit(0).cast("bigint"), lambda acc, x: acc + x[name])


def _suffix_totals(cells: DataFrame, size: int) -> DataFrame:
    """(cut, tp, fp, all_tp, all_fp): totals of the cells that reach cut 1..size, and of all cells.

    ``cells`` holds at most ``size + 1`` rows (index, tp, fp), so they fit in one row; nothing is read twice.
    """
    row = cells.agg(F.collect_list(F.struct("index", "tp", "fp")).alias("cells"))
    packed = c("cells")
    return row.select(F.inline(F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.struct(
        i.alias("cut"), _reached(packed, "tp", lambda x: x["index"] >= i).alias("tp"),
        _reached(packed, "fp", lambda x: x["index"] >= i).alias("fp"),
        _reached(packed, "tp", lambda x: F.lit(True)).alias("all_tp"),
        _reached(packed, "fp", lambda x: F.lit(True)).alias("all_fp")))))


def quantile_sweep(validation: DataFrame, y: str, score: str,
                   probs: Sequence[float] | None = None) -> DataFrame:
    """Recall, FPR and precision at quantiles of the score, prediction strictly above the cut."""
    cuts = exact_quantiles(validation, {"s": c(score)}, probs or quantile_grid())["s"]
    if any(t is None for t in cuts):
        raise ValueError("no finite score to take quantiles of")
    cells = validation.groupBy(cuts_passed(c(score), cuts, strict=True).alias("index")).agg(
        F.sum(c(y).cast("bigint")).alias("tp"), F.sum((1 - c(y)).cast("bigint")).alias("fp"))
    return _suffix_totals(cells, len(cuts)).select(
        c("cut").alias("point"), _cut_value(c("cut"), cuts).alias("threshold"),
        ratio(c("tp"), c("all_tp")).alias("recall"), ratio(c("fp"), c("all_fp")).alias("fpr"),
        F.coalesce(ratio(c("tp"), c("tp") + c("fp")), F.lit(0.0)).alias("precision"))


def recheck_sweep(matched: DataFrame, y: str, proba: str, weight: str | None = None,
                  attack_weight: str | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """False-positive reduction and attack retention (percent) at every cut, kept when proba >= cut.

    Rows may be single alerts (``y``), or keys that stand for ``weight`` alerts with ``attack_weight``
    attacks among them.
    """
    grid = list(cuts or recheck_grid())
    attacks = c(attack_weight) if attack_weight else c(y).cast("bigint")
    alerts = c(weight) if weight else F.lit(1)
    cells = matched.groupBy(cuts_passed(c(proba), grid).alias("index")).agg(
        F.sum(attacks).cast("bigint").alias("tp"), F.sum(alerts - attacks).cast("bigint").alias("fp"))
    return _suffix_totals(cells, len(grid)).select(
        _cut_value(c("cut"), grid).alias("threshold"), c("fp").alias("fp_after"), c("tp").alias("tp_kept"),
        c("all_fp").alias("fp_before"), c("all_tp").alias("tp_before"),
        F.round(100 * (1 - ratio(c("fp"), c("all_fp"))), 1).alias("fp_reduction_pct"),
        F.round(100 * ratio(c("tp"), c("all_tp")), 1).alias("attack_retention_pct"))


def operating_point(curve: DataFrame, floor: float = RETENTION_FLOOR) -> DataFrame:
    """Row with the most false positives removed among those that keep enough attacks.

    If no row keeps enough, the row that keeps the most. Ties take the lowest threshold.
    """
    row = F.struct(*[c(n) for n in curve.columns])
    low = -c("threshold")
    viable = F.when(c("attack_retention_pct") >= F.lit(floor), F.struct(c("fp_reduction_pct"), low))
    best = F.max_by(row, viable)
    fallback = F.max_by(row, F.when(c("attack_retention_pct").isNotNull(),
                                    F.struct(c("attack_retention_pct"), low)))
    return curve.agg(F.coalesce(best, fallback).alias("row")).select("row.*")


def joint_cells(df: DataFrame, y: str, first: str, second: str, cuts1: Sequence[float],
                cuts2: Sequence[float]) -> DataFrame:
    """Metrics of every (stage-1 cut, stage-2 cut) pair that flags a row, from one pass over the rows.

    Rows collapse to one cell per pair of cut indexes; those few cells fit in one row.
    """
    cells = df.groupBy(cuts_passed(c(first), cuts1).alias("i"), cuts_passed(c(second), cuts2).alias("j")).agg(
        F.sum(c(y).cast("bigint")).alias("tp"), F.sum((1 - c(y)).cast("bigint")).alias("fp"))
    row = cells.agg(F.collect_list(F.struct("i", "j", "tp", "fp")).alias("cells"))
    row = row.withColumn("pos", _reached(c("cells"), "tp", lambda x: F.lit(True)))
    pairs = (row.select("cells", "pos", F.explode(F.sequence(F.lit(1), F.lit(len(cuts1)))).alias("a"))
             .select("cells", "pos", "a", F.explode(F.sequence(F.lit(1), F.lit(len(cuts2)))).alias("b"))
             .select("a", "b", "pos", _reached(c("cells"), "tp", _both).alias("tp"),
                     _reached(c("cells"), "fp", _both).alias("fp"))
             .filter(c("tp") + c("fp") > 0))
    p, r = ratio(c("tp"), c("tp") + c("fp")), ratio(c("tp"), c("pos"))
    return pairs.select(_cut_value(c("a"), cuts1).alias("stage1_cut"),
                        _cut_value(c("b"), cuts2).alias("stage2_cut"),
                        p.alias("precision"), r.alias("recall"),
                        (2 * p * r / (p + r + F.lit(EPSILON))).alias("f1"))


def _both(x: Column) -> Column:
    return (x["i"] >= c("a")) & (x["j"] >= c("b"))


def joint_threshold(df: DataFrame, y: str, first: str, second: str, cuts1: Sequence[float] | None = None,
                    cuts2: Sequence[float] | None = None) -> DataFrame:
    """Best F1 pair of cuts when both stages must agree; ties take the lowest cuts.

    The stage-1 grid defaults to 24 quantiles of the first score, the stage-2 grid to 19 even cuts.
    """
    grid1 = list(cuts1 or exact_quantiles(df, {"s": c(first)}, quantile_grid(24))["s"])
    cells = joint_cells(df, y, first, second, grid1, list(cuts2 or recheck_grid()))
    row = F.struct(*[c(n) for n in cells.columns])
    return cells.agg(F.max_by(row, F.struct(c("f1"), -c("stage1_cut"), -c("stage2_cut"))).alias("row")
                     ).select("row.*")
