"""Direction-independent matching of alerts to merged connections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import c, endpoint_key, ratio
from ..functions.skew import even_join
from ..session import cut_lineage


def with_endpoint_key(df: DataFrame, src_ip: str, dst_ip: str, src_port: str, dst_port: str,
                      out: str = "key") -> DataFrame:
    return df.withColumn(out, endpoint_key(c(src_ip), c(dst_ip), c(src_port), c(dst_port)))


def flows_for_alerts(flows: DataFrame, alerts: DataFrame, key: str = "key",
                     salt_on: Sequence[str] | None = None) -> DataFrame:
    """Segments whose key is among the alert keys.

    Put this before the merge: the merge groups by connection id, so the optimizer cannot move the
    filter below it. The distinct alert keys are written once; they are broadcast only when they turn
    out to be few, since their number grows with the data.
    """
    wanted = cut_lineage(alerts.select(c(key)).distinct())
    return even_join(flows, wanted, key, "left_semi", salt_on or flows.columns)


def score_per_key(flows: DataFrame, key: str, flow_id: str, score: str, pick: str = "last") -> DataFrame:
    """One score per key: that of the largest connection id (``last``), or the highest (``max``)."""
    chosen = F.max(c(score)) if pick == "max" else F.max_by(c(score), c(flow_id))
    return flows.filter(c(key).isNotNull()).groupBy(c(key)).agg(chosen.alias(score))


def look_up_scores(alerts: DataFrame, scores: DataFrame, key: str = "key", how: str = "inner",
                   salt_on: Sequence[str] | None = None) -> DataFrame:
    """Put the second-stage score beside each alert. One key may hold any share of the alerts.

    ``scores`` has one row per key and should be materialised (see ``even_join``).
    """
    return even_join(alerts, scores, key, how, salt_on or alerts.columns)


def unmatched(alerts: DataFrame, scores: DataFrame, key: str = "key",
              salt_on: Sequence[str] | None = None) -> DataFrame:
    """Alerts without a connection; they keep their first-stage verdict."""
    return even_join(alerts, scores.select(c(key)), key, "left_anti", salt_on or alerts.columns)


def alerts_by_key(alerts: DataFrame, key: str, y: str) -> DataFrame:
    """Alert counts per key and label: all a summary needs, and free of hot keys before the join."""
    return alerts.groupBy(c(key)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(c(y)).cast("bigint").alias("n_attack"))


def match_rate(alerts: DataFrame, scores: DataFrame, key: str = "key", y: str = "y") -> DataFrame:
    """Flagged and matched alerts and their ratio, from pre-aggregated keys."""
    counted = alerts_by_key(alerts, key, y)
    known = scores.select(c(key), F.lit(True).alias("known"))
    matched = F.coalesce(F.sum(F.when(c("known"), c("n"))), F.lit(0))
    flagged = F.coalesce(F.sum("n"), F.lit(0))
    return counted.join(known, key, "left").agg(
        flagged.alias("flagged"), matched.alias("matched"), ratio(matched, flagged).alias("match_rate"))


def without_training_flows(flows: DataFrame, training: DataFrame, flow_id: str) -> DataFrame:
    """Segments of connections the model did not train on."""
    seen = cut_lineage(training.select(c(flow_id)).filter(c(flow_id).isNotNull()).distinct())
    return even_join(flows, seen, flow_id, "left_anti", flows.columns)
