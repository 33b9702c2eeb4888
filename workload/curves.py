"""Threshold curves, metric blocks and two-stage evaluation over scored events."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import curves, evaluation
from twinsieve.operators.detectors.simple import TwoMeansCutoff, alert_cluster, rank_fusion, two_means_split
from twinsieve.operators.sampling import class_weights, split_stratified
from twinsieve.plans import report
from twinsieve.plans.screening import flagged
from twinsieve.session import ensure_checkpoint_dir
from twinsieve.sources.sinks import read_curve, write_curve

from .base import (EVENTS_SQL, METRICS, SEED, VERDICTS_SQL, events, round6, sql_cells, sql_draw, sql_metrics,
                   sql_quantiles, table, verdicts)


def judged(spark, sf_dir):
    return events(spark, sf_dir).withColumn("pred", (c("score") >= 60).cast("int"))


def pr_curve(spark, sf_dir):
    return round6(curves.pr_curve(events(spark, sf_dir), "y", "score"), "precision", "recall")


def roc_curve(spark, sf_dir):
    return round6(curves.roc_curve(events(spark, sf_dir), "y", "score"), "fpr", "tpr")


def roc_auc(spark, sf_dir):
    return round6(curves.roc_auc(events(spark, sf_dir), "y", "score"), "auc")


def f1_threshold(spark, sf_dir):
    return round6(curves.f1_threshold(events(spark, sf_dir), "y", "score"), "f1")


def recall_threshold(spark, sf_dir):
    return curves.recall_threshold(events(spark, sf_dir), "y", "score")


def quantile_sweep(spark, sf_dir):
    return round6(curves.quantile_sweep(events(spark, sf_dir), "y", "score"), "threshold", "recall", "fpr", "precision")


def class_quantile_cut(spark, sf_dir):
    """The cut, and how many rows of each class pass it."""
    rows = events(spark, sf_dir)
    cut = curves.class_quantile_cut(rows, "y", "score")
    return _passing(rows, cut)


def contamination_cut(spark, sf_dir):
    rows = events(spark, sf_dir)
    return _passing(rows, curves.contamination_cut(rows, "score"), strict=True)


def _passing(rows, cut, strict=False):
    passing = c("score") > F.lit(cut) if strict else c("score") >= F.lit(cut)
    return rows.filter(passing).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "cut", F.round(F.lit(cut), 6))


def robust_trim(spark, sf_dir):
    kept, _ = curves.worst_trimmed(events(spark, sf_dir), "score")
    return kept.select("event_id", "score")


def rank_fusion_query(spark, sf_dir):
    fused = rank_fusion(events(spark, sf_dir), ["score", "s2"], "event_id")
    return round6(fused.select("event_id", "fused"), "fused", digits=9)


def two_means_cut(spark, sf_dir):
    """Best two clusters on log1p(score)."""
    return round6(two_means_split(events(spark, sf_dir), "score"), "low_centre", "high_centre", "cut")


def two_means_alerts(spark, sf_dir):
    """Size and mean score of both clusters, and which one alerts."""
    rows = events(spark, sf_dir)
    placed = TwoMeansCutoff().fit(rows).transform(rows)
    found = placed.groupBy("alert").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_error"))
    chosen = alert_cluster(placed, "alert", "score").select("alert_cluster").scalar()
    return round6(found.withColumn("alerts", c("alert") == chosen), "mean_error")


def joint_threshold(spark, sf_dir):
    return round6(curves.joint_threshold(events(spark, sf_dir), "y", "score", "s2"),
                  "stage1_cut", "precision", "recall", "f1")


def detection_by_class(spark, sf_dir):
    return round6(evaluation.detection_by_class(judged(spark, sf_dir), "event_type", "pred"), "detection_rate")


def confusion(spark, sf_dir):
    return evaluation.confusion(judged(spark, sf_dir), "y", "pred")


def metric_block(spark, sf_dir):
    return round6(evaluation.evaluate(judged(spark, sf_dir), "y", "pred"), *METRICS)


def long_metrics(spark, sf_dir):
    blocks = evaluation.cascade_union(verdicts(spark, sf_dir), "y", "s1", "s2")
    return round6(evaluation.long_metrics(blocks), "value")


def cascade_union(spark, sf_dir):
    return round6(evaluation.cascade_union(verdicts(spark, sf_dir), "y", "s1", "s2"), *METRICS)


def cascade_by_class(spark, sf_dir):
    return round6(evaluation.detection_cascade_union(verdicts(spark, sf_dir), "event_type", "s1", "s2"),
                  "cascade_and", "union_or")


def combined_confusion(spark, sf_dir):
    return round6(evaluation.combined_confusion(verdicts(spark, sf_dir), "y", "s1", "s2"), *METRICS, "fp_reduction")


def final_verdicts(spark, sf_dir):
    return evaluation.with_final_verdict(verdicts(spark, sf_dir), "s1", "s2")


def mcnemar_counts(spark, sf_dir):
    return evaluation.mcnemar_counts(final_verdicts(spark, sf_dir), "y", "s1", "final")


def mcnemar(spark, sf_dir):
    return round6(evaluation.mcnemar(final_verdicts(spark, sf_dir), "y", "s1", "final"), "p_value")


def mcnemar_close(spark, sf_dir):
    """Two verdicts that differ little, so the p-value is not 0."""
    rows = events(spark, sf_dir).select(
        "y", (c("score") >= 60).cast("int").alias("a"), (c("s2") * 115 >= 60).cast("int").alias("b2"))
    return round6(evaluation.mcnemar(rows, "y", "a", "b2"), "p_value")


def bootstrap_cells(spark, sf_dir):
    return evaluation.joint_counts(final_verdicts(spark, sf_dir), "y", "s1", "final").withColumnRenamed("s2", "final")


def bootstrap_ci(spark, sf_dir):
    return evaluation.bootstrap_ci(verdicts(spark, sf_dir), "y", "s1", "s2")


def system_comparison(spark, sf_dir):
    rows = events(spark, sf_dir)
    return round6(evaluation.system_comparison(rows, "y", {
        "score_low": c("score") >= 30, "score_high": c("score") >= 90, "hash": c("s2") >= 0.5}), *METRICS)


def screening_load(spark, sf_dir):
    return round6(evaluation.screening_load(verdicts(spark, sf_dir), "y", "s1", "s2"),
                  "screening_load", "precision_before", "precision_after")


def stage_report(spark, sf_dir):
    return round6(report.stage_report(verdicts(spark, sf_dir), "y", "s1", "s2"), *METRICS)


def grain_auc(spark, sf_dir):
    """AUC of a given score at both grains: single records and merged connections that carry their records' labels."""
    single = events(spark, sf_dir).select(F.lit("record").alias("grain"), "y", "score")
    merged = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(
        F.max(((c("l_quantity") >= 49) & (c("l_discount") >= 0.09)).cast("int")).alias("y"), F.sum("l_quantity").alias("score"))
    connection = merged.select(F.lit("connection").alias("grain"), "y", "score")
    return round6(curves.roc_auc(single.unionByName(connection), "y", "score", ["grain"]), "auc")


def class_weight(spark, sf_dir):
    return round6(class_weights(table(spark, sf_dir, "labels"), "toxic"), "weight")


def screen_alerts(spark, sf_dir):
    """Given score: cut from the validation rows, alerts among the test rows."""
    parts = split_stratified(events(spark, sf_dir), ["event_id"], "y", 0.30, 0.20, SEED)
    cut = curves.recall_threshold(parts.filter(c("split") == "val"), "y", "score").first()["threshold"]
    return flagged(parts.filter(c("split") == "test"), "score", cut).select("event_id", "event_type", "y", "score")


def curve_sink(spark, sf_dir):
    """The curve of all events, written in ordered parts with a manifest and read back."""
    path = f"{ensure_checkpoint_dir(spark)}/curve-{uuid.uuid4().hex}"
    write_curve(pr_curve(spark, sf_dir), path)
    return read_curve(spark, path).drop("part")


QUERIES = {
    "curve_sink": curve_sink,
    "pr_curve": pr_curve, "roc_curve": roc_curve, "roc_auc": roc_auc, "f1_threshold": f1_threshold,
    "recall_threshold": recall_threshold, "quantile_sweep": quantile_sweep, "class_quantile_cut": class_quantile_cut,
    "contamination_cut": contamination_cut, "robust_trim": robust_trim, "rank_fusion": rank_fusion_query,
    "two_means_cut": two_means_cut, "two_means_alerts": two_means_alerts, "joint_threshold": joint_threshold, "detection_by_class": detection_by_class, "confusion": confusion,
    "metric_block": metric_block, "long_metrics": long_metrics, "cascade_union": cascade_union,
    "cascade_by_class": cascade_by_class, "combined_confusion": combined_confusion, "mcnemar_counts": mcnemar_counts,
    "mcnemar": mcnemar, "mcnemar_close": mcnemar_close, "bootstrap_cells": bootstrap_cells,
    "bootstrap_ci": bootstrap_ci, "system_comparison": system_comparison, "screening_load": screening_load,
    "stage_report": stage_report, "grain_auc": grain_auc, "class_weight": class_weight,
    "screen_alerts": screen_alerts,
}

_EV, _VD = f"WITH {EVENTS_SQL}", f"WITH {VERDICTS_SQL}"
_FINAL = "CASE WHEN s1 = 1 AND coalesce(s2, 1) = 1 THEN 1 ELSE 0 END"


def _curve(source: str = "ev") -> str:
    return f"""hi AS (SELECT score AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM {source} GROUP BY score),
cu AS (SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
              sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
       FROM hi WINDOW w AS (ORDER BY threshold DESC)),
pr AS (SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, tp / (tp + fp)::DOUBLE AS precision, tp / all_pos::DOUBLE AS recall FROM cu),
f1 AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM pr)"""


def _systems(entries: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS system, {sql_cells(pred)} FROM {source}" for name, pred in entries.items())


_FOUR = {"stage1": "s1", "stage2": "coalesce(s2, 0)", "cascade_and": "(s1 & coalesce(s2, 0))",
         "union_or": "(s1 | coalesce(s2, 0))"}
_QUANTILES = curves.quantile_grid()
_QUANTILES24 = curves.quantile_grid(24)
_GRID = ", ".join(f"({t!r}e0)" for t in curves.recheck_grid())
_DISCORDANT = "count(*) FILTER (WHERE {a} <> y AND {b} = y) AS b, count(*) FILTER (WHERE {a} = y AND {b} <> y) AS c"
# Exact binomial tail at one half, summed term by term in logarithms.
_TAIL = """SELECT b, c, round(least(1e0, 2 * (SELECT sum(exp(lgamma(b + c + 1) - lgamma(k + 1) - lgamma(b + c - k + 1) - (b + c) * ln(2)))
                                              FROM range(0, least(b, c) + 1) AS r(k))), 6) AS p_value FROM d"""
_VERDICT = """SELECT b, c, p_value, p_value < 0.05 AS significant,
  CASE WHEN p_value >= 0.05 THEN 'not significant at alpha=0.05' WHEN b > c THEN 'significant improvement'
       ELSE 'significantly worse' END AS verdict FROM t"""

_TWO_MEANS = """lg AS (SELECT ln(1 + score) AS v, count(*) AS n FROM ev GROUP BY 1),
        cs AS (SELECT v, sum(n) OVER w AS n1, sum(n * v) OVER w AS s1, sum(n) OVER () AS na, sum(n * v) OVER () AS sa
               FROM lg WINDOW w AS (ORDER BY v)),
        best AS (SELECT s1 / n1 AS low_centre, (sa - s1) / (na - n1) AS high_centre FROM cs WHERE n1 < na
                 ORDER BY s1 * s1 / n1 + (sa - s1) * (sa - s1) / (na - n1) DESC LIMIT 1)"""

ORACLES = {
    "pr_curve": f"{_EV}, {_curve()} SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr",
    "curve_sink": f"{_EV}, {_curve()} SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr",
    "roc_curve": f"""{_EV}, {_curve()}
        SELECT threshold, round(fp / all_neg::DOUBLE, 6) AS fpr, round(tp / all_pos::DOUBLE, 6) AS tpr FROM cu""",
    "roc_auc": f"""{_EV}, {_curve()}
        SELECT round(sum(neg * (tp - pos + pos * 0.5e0)) / (max(all_pos) * max(all_neg)::DOUBLE), 6) AS auc FROM cu""",
    "f1_threshold": f"{_EV}, {_curve()} SELECT threshold, round(f1, 6) AS f1 FROM f1 ORDER BY f1.f1 DESC, threshold LIMIT 1",
    "recall_threshold": f"""{_EV}, {_curve()}
        SELECT coalesce(max(threshold) FILTER (WHERE recall >= 0.85e0),
                        (SELECT threshold FROM f1 ORDER BY f1 DESC, threshold LIMIT 1)) AS threshold,
               max(recall) >= 0.85e0 AS target_met FROM pr""",
    "quantile_sweep": f"""{_EV}
        SELECT point, round(cut, 6) AS threshold,
               round(count(*) FILTER (WHERE score > cut AND y = 1) / (SELECT sum(y) FROM ev)::DOUBLE, 6) AS recall,
               round(count(*) FILTER (WHERE score > cut AND y = 0) / (SELECT sum(1 - y) FROM ev)::DOUBLE, 6) AS fpr,
               round(coalesce(count(*) FILTER (WHERE score > cut AND y = 1) / nullif(count(*) FILTER (WHERE score > cut), 0)::DOUBLE, 0), 6) AS precision
        FROM {sql_quantiles('ev', 'score', _QUANTILES)} q, ev GROUP BY point, cut""",
    "class_quantile_cut": f"""{_EV}, att AS (SELECT * FROM ev WHERE y = 1)
        SELECT event_type, count(*) AS n, round(cut, 6) AS cut
        FROM ev, {sql_quantiles('att', 'score', [1.0 - 0.90])} q WHERE score >= cut GROUP BY event_type, cut""",
    "contamination_cut": f"""{_EV}
        SELECT event_type, count(*) AS n, round(cut, 6) AS cut
        FROM ev, {sql_quantiles('ev', 'score', [1.0 - 0.02])} q WHERE score > cut GROUP BY event_type, cut""",
    "robust_trim": f"""{_EV}
        SELECT event_id, score FROM ev, {sql_quantiles('ev', 'score', [1.0 - 0.10])} q WHERE score <= cut""",
    "rank_fusion": f"""{_EV}, r AS (
          SELECT event_id, (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) * 0.5e0) / count(*) OVER () AS r1,
                 (rank() OVER (ORDER BY s2) + (count(*) OVER (PARTITION BY s2) - 1) * 0.5e0) / count(*) OVER () AS r2 FROM ev)
        SELECT event_id, round((r1 + r2) / 2, 9) AS fused FROM r""",
    "two_means_cut": f"""{_EV}, {_TWO_MEANS}
        SELECT round(low_centre, 6) AS low_centre, round(high_centre, 6) AS high_centre, round((low_centre + high_centre) / 2, 6) AS cut FROM best""",
    "two_means_alerts": f"""{_EV}, {_TWO_MEANS},
        p AS (SELECT score, CASE WHEN ln(1 + score) > (low_centre + high_centre) / 2 THEN 1 ELSE 0 END AS alert FROM ev, best)
        SELECT alert, count(*) AS n, round(avg(score), 6) AS mean_error, alert = 1 AS alerts FROM p GROUP BY alert""",
    "joint_threshold": f"""{_EV}, a AS (SELECT cut FROM {sql_quantiles('ev', 'score', _QUANTILES24)}),
        j AS (SELECT cut AS stage1_cut, t AS stage2_cut, count(*) FILTER (WHERE y = 1) AS tp, count(*) AS flagged
              FROM ev JOIN a ON score >= cut JOIN (VALUES {_GRID}) AS g(t) ON s2 >= t GROUP BY cut, t),
        m AS (SELECT *, tp / flagged::DOUBLE AS precision, tp / (SELECT sum(y) FROM ev)::DOUBLE AS recall FROM j),
        f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM m)
        SELECT round(stage1_cut, 6) AS stage1_cut, stage2_cut, round(precision, 6) AS precision,
               round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM f ORDER BY f.f1 DESC, f.stage1_cut, f.stage2_cut LIMIT 1""",
    "detection_by_class": f"""{_EV}
        SELECT event_type, count(*) AS n, round(avg(CASE WHEN score >= 60 THEN 1e0 ELSE 0e0 END), 6) AS detection_rate
        FROM ev GROUP BY event_type""",
    "confusion": f"{_EV}, p AS (SELECT y, CASE WHEN score >= 60 THEN 1 ELSE 0 END AS pred FROM ev) SELECT {sql_cells('pred')} FROM p",
    "metric_block": f"""{_EV}, p AS (SELECT y, CASE WHEN score >= 60 THEN 1 ELSE 0 END AS pred FROM ev)
        {sql_metrics(f"SELECT {sql_cells('pred')} FROM p")}""",
    "long_metrics": f"""{_VD}, m AS ({sql_metrics(_systems(_FOUR, 'vd'))}),
        w AS (SELECT system, tn::DOUBLE AS tn, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tp::DOUBLE AS tp, precision, recall, f1, fpr, fnr, accuracy FROM m)
        SELECT system, metric, value FROM (UNPIVOT w ON COLUMNS(* EXCLUDE (system)) INTO NAME metric VALUE value)""",
    "cascade_union": f"{_VD} {sql_metrics(_systems(_FOUR, 'vd'))}",
    "cascade_by_class": f"""{_VD}
        SELECT event_type, count(*) AS n, round(avg((s1 & coalesce(s2, 0))::DOUBLE), 6) AS cascade_and,
               round(avg((s1 | coalesce(s2, 0))::DOUBLE), 6) AS union_or FROM vd GROUP BY event_type""",
    "combined_confusion": f"""{_VD}, f AS (SELECT *, {_FINAL} AS final FROM vd)
        SELECT *, (SELECT round(1 - count(*) FILTER (WHERE y = 0 AND final = 1) / count(*) FILTER (WHERE y = 0 AND s1 = 1)::DOUBLE, 6)
                   FROM f) AS fp_reduction
        FROM ({sql_metrics(f"SELECT {sql_cells('final')} FROM f")})""",
    "mcnemar_counts": f"""{_VD}, f AS (SELECT *, {_FINAL} AS final FROM vd)
        SELECT {_DISCORDANT.format(a='s1', b='final')} FROM f""",
    "mcnemar": f"""{_VD}, f AS (SELECT *, {_FINAL} AS final FROM vd),
        d AS (SELECT {_DISCORDANT.format(a='s1', b='final')} FROM f), t AS ({_TAIL}) {_VERDICT}""",
    "mcnemar_close": f"""{_EV}, f AS (SELECT y, CASE WHEN score >= 60 THEN 1 ELSE 0 END AS a1,
                                             CASE WHEN s2 * 115 >= 60 THEN 1 ELSE 0 END AS b1 FROM ev),
        d AS (SELECT {_DISCORDANT.format(a='a1', b='b1')} FROM f), t AS ({_TAIL}) {_VERDICT}""",
    "bootstrap_cells": f"{_VD} SELECT y, s1, {_FINAL} AS final, count(*) AS n FROM vd GROUP BY ALL",
    "system_comparison": f"""{_EV}, p AS (SELECT y, (score >= 30)::INT AS a, (score >= 90)::INT AS b, (s2 >= 0.5e0)::INT AS h FROM ev)
        {sql_metrics(_systems({'score_low': 'a', 'score_high': 'b', 'hash': 'h'}, 'p'))}""",
    "screening_load": f"""{_VD}, f AS (SELECT *, {_FINAL} AS final FROM vd)
        SELECT round(avg(s1), 6) AS screening_load,
               round(count(*) FILTER (WHERE s1 = 1 AND y = 1) / count(*) FILTER (WHERE s1 = 1)::DOUBLE, 6) AS precision_before,
               round(count(*) FILTER (WHERE final = 1 AND y = 1) / count(*) FILTER (WHERE final = 1)::DOUBLE, 6) AS precision_after
        FROM f""",
    "stage_report": f"""{_VD}, f AS (SELECT *, {_FINAL} AS final FROM vd)
        SELECT system, tn, fp, fn, tp, precision, recall, f1, accuracy
        FROM ({sql_metrics(_systems({'stage1': 's1', 'stage2': 's2', 'combined': 'final'}, 'f'))})""",
    "grain_auc": f"""{_EV}, g AS (
          SELECT 'record' AS grain, y, score FROM ev UNION ALL
          SELECT 'connection', max((l_quantity >= 49 AND l_discount >= 0.09)::INT), sum(l_quantity) FROM lineitem GROUP BY l_suppkey, l_linenumber),
        hi AS (SELECT grain, score, sum(y) AS pos, sum(1 - y) AS neg FROM g GROUP BY grain, score),
        cu AS (SELECT grain, pos, neg, sum(pos) OVER (PARTITION BY grain ORDER BY score DESC) AS tp,
                      sum(pos) OVER (PARTITION BY grain) AS p, sum(neg) OVER (PARTITION BY grain) AS n FROM hi)
        SELECT grain, round(sum(neg * (tp - pos + pos * 0.5e0)) / (max(p) * max(n)::DOUBLE), 6) AS auc FROM cu GROUP BY grain""",
    "class_weight": """
        SELECT toxic, count(*) AS n, round((SELECT count(*) FROM labels) / (2e0 * count(*)), 6) AS weight
        FROM labels GROUP BY toxic""",
    "screen_alerts": f"""{_EV},
        k AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sql_draw('event_id')}, event_id) AS k,
                     count(*) OVER (PARTITION BY y) AS n FROM ev),
        sp AS (SELECT *, CASE WHEN k <= round(n * 0.3e0) THEN 'test'
                              WHEN k <= round(n * 0.3e0) + round((n - round(n * 0.3e0)) * 0.2e0) THEN 'val' ELSE 'train' END AS split FROM k),
        va AS (SELECT * FROM sp WHERE split = 'val'), {_curve('va')},
        th AS (SELECT coalesce(max(threshold) FILTER (WHERE recall >= 0.85e0),
                               (SELECT threshold FROM f1 ORDER BY f1 DESC, threshold LIMIT 1)) AS t FROM pr)
        SELECT event_id, event_type, y, score FROM sp, th WHERE split = 'test' AND score >= t""",
}
