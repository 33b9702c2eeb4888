"""Stage 2: find the connection of every alert, score it, choose the operating point."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c, nan_to_null, ratio
from ..operators.curves import RETENTION_FLOOR, operating_point, recheck_sweep
from ..operators.matching import (alerts_by_key, flows_for_alerts, look_up_scores, score_per_key,
                                  with_endpoint_key, without_training_flows)
from ..operators.segments import IDENTITY, merge_segments
from ..session import cut_lineage


@dataclass(frozen=True)
class FlowColumns:
    """Names of the endpoint columns of a segment table."""

    flow_id: str = "Flow ID"
    src_ip: str = "Src IP"
    dst_ip: str = "Dst IP"
    src_port: str = "Src Port"
    dst_port: str = "Dst Port"
    order: Sequence[str] = ("Timestamp",)

    @property
    def endpoints(self) -> tuple[str, str, str, str]:
        return self.src_ip, self.dst_ip, self.src_port, self.dst_port


def flow_scores(segments: DataFrame, alerts: DataFrame, score: Callable[[DataFrame], DataFrame],
                columns: FlowColumns = FlowColumns(), training: DataFrame | None = None,
                pick: str = "last") -> DataFrame:
    """(key, proba) of every connection an alert points to.

    Segments are cut down to the alerts' keys first, and to connections outside the training set, so the
    merge and the model only see what is needed. ``score`` adds ``proba`` to merged connections. The
    result is written to the checkpoint folder, because sweep, summary and look-up all read it.
    """
    fresh = segments if training is None else without_training_flows(segments, training, columns.flow_id)
    keyed = with_endpoint_key(fresh, *columns.endpoints)
    wanted = flows_for_alerts(keyed, alerts).drop("key")
    identity = list(dict.fromkeys([*IDENTITY, *columns.endpoints, columns.order[0]]))
    merged = merge_segments(wanted, [columns.flow_id], columns.order, [n for n in identity if n != columns.flow_id])
    scored = with_endpoint_key(score(merged), *columns.endpoints)
    scored = scored.withColumn("proba", nan_to_null(c("proba")))      # a score that is not a number is none
    return cut_lineage(score_per_key(scored, "key", columns.flow_id, "proba", pick))


def match_alerts(alerts: DataFrame, scores: DataFrame, row_id: str, cut: float | None = None) -> DataFrame:
    """Alerts with the score of their connection; ``kept`` is null where none was found."""
    looked = look_up_scores(alerts, scores, "key", "left", [row_id])
    return looked if cut is None else looked.withColumn("kept", (c("proba") >= F.lit(cut)).cast("int"))


def matched_keys(alerts: DataFrame, scores: DataFrame, y: str = "y") -> DataFrame:
    """(key, n, n_attack, proba): alerts folded per key before they meet the scores.

    Everything a sweep or summary needs, and a key with a third of all alerts is one row.
    """
    return alerts_by_key(alerts, "key", y).join(scores, "key", "left")


def sweep_keys(keys: DataFrame, cuts: Sequence[float] | None = None) -> DataFrame:
    return recheck_sweep(keys.filter(c("proba").isNotNull()), "y", "proba", "n", "n_attack", cuts)


def choose_cut(keys: DataFrame, floor: float = RETENTION_FLOOR, cuts: Sequence[float] | None = None) -> DataFrame:
    return operating_point(sweep_keys(keys, cuts), floor)


def recheck_summary(keys: DataFrame, cut: float | Column) -> DataFrame:
    """Flagged, matched, false positives and attacks before and after the cut, as one row of counts."""
    cut = cut if isinstance(cut, Column) else F.lit(float(cut))
    matched, kept = c("proba").isNotNull(), c("proba") >= cut
    attacks, benign = c("n_attack"), c("n") - c("n_attack")

    def total(value: Column, condition: Column | None = None) -> Column:
        value = value if condition is None else F.when(condition, value)
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return keys.agg(
        total(c("n")).alias("flagged"), total(c("n"), matched).alias("matched"),
        total(benign, matched).alias("fp_before"), total(benign, kept).alias("fp_after"),
        total(attacks, matched).alias("tp_before"), total(attacks, kept).alias("tp_kept"))


def with_percentages(summary: DataFrame) -> DataFrame:
    """Add match rate, false-positive reduction and attack retention to a summary row."""
    return summary.select(
        "*", F.round(ratio(c("matched"), c("flagged")), 3).alias("match_rate"),
        F.round(100 * (1 - ratio(c("fp_after"), c("fp_before"))), 1).alias("fp_reduction_pct"),
        F.round(100 * ratio(c("tp_kept"), c("tp_before")), 1).alias("attack_retention_pct"))


def recheck(alerts: DataFrame, segments: DataFrame, score: Callable[[DataFrame], DataFrame],
            columns: FlowColumns = FlowColumns(), training: DataFrame | None = None,
            floor: float = RETENTION_FLOOR) -> DataFrame:
    """Whole re-check: key, semi-join, merge, score, look-up, sweep, choice, summary."""
    scores = flow_scores(segments, alerts, score, columns, training)
    keys = cut_lineage(matched_keys(alerts, scores))
    cut = choose_cut(keys, floor).select("threshold").scalar()
    return with_percentages(recheck_summary(keys, cut)).withColumn("threshold", cut)
