import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from twinsieve.functions.columns import c
from twinsieve.operators import curves, evaluation as e
from twinsieve.operators.detectors.simple import rank_fusion
from twinsieve.plans import report

TIED = [(1, .9), (1, .9), (0, .9), (1, .8), (0, .7), (0, .7), (1, .7), (0, .6), (0, .5), (1, .5), (0, .5), (0, .4),
        (0, .4), (1, .3), (0, .2), (0, .2), (0, .1), (0, .1), (0, .0), (1, .0)]


def scored(spark, rows=TIED):
    return spark.createDataFrame([(i, y, float(s)) for i, (y, s) in enumerate(rows)], "row_id long, y int, score double")


def brute(rows):
    """Threshold, precision and recall at every distinct score, one threshold at a time."""
    pos = sum(y for y, _ in rows)
    out = {}
    for t in sorted({s for _, s in rows}):
        hit = [y for y, s in rows if s >= t]
        out[t] = (sum(hit) / len(hit), sum(hit) / pos if pos else None)
    return out


def test_pr_curve_with_ties(spark):
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in curves.pr_curve(scored(spark), "y", "score").collect()}
    assert got == brute(TIED)


def test_thresholds(spark):
    table = brute(TIED)
    f1 = {t: 2 * p * r / (p + r + 1e-12) for t, (p, r) in table.items()}
    best = min(t for t in f1 if f1[t] == max(f1.values()))
    assert curves.f1_threshold(scored(spark), "y", "score").first()["threshold"] == best
    reach = curves.recall_threshold(scored(spark), "y", "score", 0.85).first()
    assert reach["threshold"] == max(t for t, (_, r) in table.items() if r >= 0.85) and reach["target_met"]
    missed = curves.recall_threshold(scored(spark), "y", "score", 1.5).first()
    assert missed["threshold"] == best and not missed["target_met"]


def test_one_class_only(spark):
    negatives = scored(spark, [(0, .1), (0, .2)])
    assert curves.roc_auc(negatives, "y", "score").first()["auc"] is None
    assert [r["recall"] for r in curves.pr_curve(negatives, "y", "score").collect()] == [None, None]
    positives = scored(spark, [(1, .1), (1, .2)])
    assert curves.f1_threshold(positives, "y", "score").first()["threshold"] == .1


def test_auc_agrees_with_built_in_evaluator(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.random() < .2), float(round(rng.random(), 2))) for _ in range(2000)]
    df = scored(spark, rows)
    built_in = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df)
    assert curves.roc_auc(df, "y", "score").first()["auc"] == pytest.approx(built_in, abs=1e-9)


def test_quantile_sweep_counts_strictly_above(spark):
    df = scored(spark)
    got = curves.quantile_sweep(df, "y", "score", [0.5, 0.9]).orderBy("point").collect()
    cuts = np.quantile([s for _, s in TIED], [0.5, 0.9])
    for r, t in zip(got, cuts):
        assert r["threshold"] == pytest.approx(t)
        assert r["recall"] == sum(y for y, s in TIED if s > t) / sum(y for y, _ in TIED)


def test_stored_curve_chooses_its_operating_point(spark):
    reduction = [91.5, 94.8, 97.3, 98.8, 99.2, 99.3, 99.4, 99.4, 99.5, 99.5, 99.5, 99.6, 99.6, 99.6, 99.6, 99.6, 100.0, 100.0, 100.0]
    retention = [97.0, 92.8, 89.7, 88.3, 84.3, 81.3, 78.4, 75.1, 73.9, 72.6, 70.6, 67.4, 65.8, 63.2, 60.5, 57.8, 54.2, 49.4, 41.4]
    curve = spark.createDataFrame(list(zip(curves.recheck_grid(), reduction, retention)),
                                  "threshold double, fp_reduction_pct double, attack_retention_pct double")
    assert curves.operating_point(curve).first()["threshold"] == 0.10
    assert curves.operating_point(curve, floor=99.0).first()["threshold"] == 0.05
    tied = curve.withColumn("fp_reduction_pct", F.lit(50.0))
    assert curves.operating_point(tied).first()["threshold"] == 0.05


def test_joint_threshold_by_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(int(rng.random() < .3), float(rng.random()), float(rng.random())) for _ in range(400)]
    rows = [(y, a + .3 * y, b + .2 * y) for y, a, b in rows]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    grid1, grid2 = [.2, .5, .8], [.1, .4, .7]
    best = max(((2 * tp / (2 * tp + fp + fn), -i, -j) for i in grid1 for j in grid2
                for tp, fp, fn in [(sum(y for y, a, b in rows if a >= i and b >= j), sum(1 - y for y, a, b in rows if a >= i and b >= j),
                                    sum(y for y, a, b in rows if not (a >= i and b >= j)))]))
    got = curves.joint_threshold(df, "y", "a", "b", grid1, grid2).first()
    assert (got["stage1_cut"], got["stage2_cut"]) == (-best[1], -best[2])
    assert got["f1"] == pytest.approx(best[0])


TWO_STAGE = [(y, s1, s2) for y in (0, 1) for s1 in (0, 1) for s2 in (0, 1, None)]
SIZES = [3, 2, 1, 6, 2, 1, 1, 1, 1, 2, 8, 2]


def two_stage(spark):
    rows = [cell for cell, n in zip(TWO_STAGE, SIZES) for _ in range(n)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, y int, s1 int, s2 int")


def test_combined_counts_move_only_cleared_alerts(spark):
    df = two_stage(spark)
    row = e.combined_confusion(df, "y", "s1", "s2").first().asDict()
    stage1 = e.confusion(df, "y", "s1").first().asDict()
    cleared = {y: df.filter((c("s1") == 1) & (c("s2") == 0) & (c("y") == y)).count() for y in (0, 1)}
    assert (row["tn"], row["fp"]) == (stage1["tn"] + cleared[0], stage1["fp"] - cleared[0])
    assert (row["fn"], row["tp"]) == (stage1["fn"] + cleared[1], stage1["tp"] - cleared[1])
    assert row["fp_reduction"] == pytest.approx(1 - row["fp"] / stage1["fp"])


def test_stored_counters(spark):
    combined = (57604, 2310, 228, 1018)
    block = e.metric_block(spark.createDataFrame([combined], "tn long, fp long, fn long, tp long")).first()
    assert [round(block[k], 4) for k in ("precision", "recall", "f1", "accuracy")] == [0.3059, 0.817, 0.4451, 0.9585]
    first = e.metric_block(spark.createDataFrame([(32919, 26995, 158, 1088)], "tn long, fp long, fn long, tp long")).first()
    assert (first["precision"], first["fpr"]) == (pytest.approx(0.03874229961186483), pytest.approx(0.4505624728777915))


def test_bootstrap_of_nothing_is_null(spark):
    none = two_stage(spark).limit(0)
    row = e.bootstrap_ci(none, "y", "s1", "s2", replicates=5).first()
    assert (row["ci_low"], row["ci_high"], row["replicates"]) == (None, None, 0)


def test_empty_prediction_has_zero_precision(spark):
    row = e.evaluate(scored(spark).withColumn("pred", F.lit(0)), "y", "pred").first()
    assert (row["precision"], row["recall"], row["f1"], row["fnr"]) == (0.0, 0.0, 0.0, 1.0)


@pytest.mark.parametrize("b,k", [(0, 0), (3, 3), (1, 9), (12, 5), (24685, 70)])
def test_binomial_tail(b, k):
    n = b + k
    exact = 1.0 if 2 * min(b, k) >= n else min(1.0, 2 * sum(math.comb(n, i) for i in range(min(b, k) + 1)) / 2 ** n)
    assert e.binomial_two_sided(b, k) == pytest.approx(exact, rel=1e-9, abs=1e-300)


def test_verdicts():
    assert e.verdict_text(0, 0, 1.0) == "no discordant pairs"
    assert e.verdict_text(24685, 70, 0.0) == "significant improvement"
    assert e.verdict_text(1, 20, 0.001) == "significantly worse"
    assert e.verdict_text(4, 5, 1.0).startswith("not significant")


def test_bootstrap_interval_holds_the_gain(spark):
    df = two_stage(spark)
    one, two = (e.bootstrap_ci(df, "y", "s1", "s2", 500).first().asDict() for _ in range(2))
    assert one == two and one["ci_low"] <= one["f1_gain"] <= one["ci_high"] and one["replicates"] == 500


def test_report_and_significance(spark):
    df = two_stage(spark)
    got = {r["system"]: r for r in report.stage_report(df, "y", "s1", "s2").collect()}
    assert sum(got["stage2"][k] for k in ("tn", "fp", "fn", "tp")) == df.filter("s2 IS NOT NULL").count()
    row = report.significance(df, "y", "s1", "s2").first()
    assert (row["b"], row["c"]) == (6, 2) and row["p_value"] == pytest.approx(e.binomial_two_sided(6, 2))


def test_rank_fusion_averages_ties(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 1.0, 1.0), (3, 2.0, 3.0), (4, 9.0, 3.0)], "row_id int, a double, b double")
    got = {r["row_id"]: r["fused"] for r in rank_fusion(df, ["a", "b"], "row_id").collect()}
    assert got == {1: (1.5 + 4) / 8, 2: (1.5 + 1) / 8, 3: (3 + 2.5) / 8, 4: (4 + 2.5) / 8}


def test_rank_fusion_takes_as_many_jobs_for_many_scores_as_for_two(spark):
    columns = [f"s{k}" for k in range(7)]
    df = spark.range(400).select("id", *[F.pmod(F.hash("id", F.lit(k)), F.lit(50)).cast("double").alias(n) for k, n in enumerate(columns)])
    jobs = {}
    for n in (2, 7):
        spark.sparkContext.setJobGroup(f"fusion{n}", "")
        got = {r["id"]: r["fused"] for r in rank_fusion(df, columns[:n], "id").collect()}
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fusion{n}"))
        rows = df.toPandas()
        want = rows[columns[:n]].rank(pct=True).mean(axis=1)
        assert all(got[i] == pytest.approx(w, abs=1e-12) for i, w in zip(rows.id, want))
    assert jobs[2] == jobs[7]


def test_rank_fusion_of_missing_scores_and_signed_zeros(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, -0.0, 2.0), (3, 5.0, None), (4, float("nan"), 3.0)], "id long, a double, b double")
    got = {r["id"]: r["fused"] for r in rank_fusion(df, ["a", "b"], "id").collect()}
    assert got[1] == pytest.approx((0.5 + 1 / 3) / 2) and got[2] == pytest.approx((0.5 + 2 / 3) / 2) and got[3] is None and got[4] is None
